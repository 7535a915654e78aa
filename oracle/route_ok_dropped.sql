select "recordId", case when problem is null then 'Ok' else 'Dropped' end as result,
       problem is null as has_data
from records
