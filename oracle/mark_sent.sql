select patient_id, alert_id,
       case when event_id % 2 = 0 and sent is not true then true else sent end as sent,
       case when event_id % 2 = 0 and sent is not true then as_of end as delivery_ts
from alerts, now_at
