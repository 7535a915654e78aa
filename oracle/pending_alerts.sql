select case when event_id % 5 < 2 then 'INSERT' else 'MODIFY' end as op, patient_id, alert_id,
       sent::varchar as sent
from alerts
where event_id % 5 < 4 and sent is not true
