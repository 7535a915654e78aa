select "recordId", event_id % 20 <> 6 as readable,
       case when event_id % 20 = 5 then 'ARRAY' when event_id % 20 not in (0, 6) then 'OBJECT' end
         as json_type,
       case when event_id % 20 not in (0, 5, 6) then trace_id end as trace_id
from records
