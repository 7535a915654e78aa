, due as (
  select *, event_id % 5 < 4 and sent is not true and patient_id <> 'P000007' as done from alerts
)
select patient_id, alert_id, case when done then true else sent end as sent, done as delivered
from due
