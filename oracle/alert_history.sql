select patient_id, rule, severity, "value", threshold, event_ts
from alerts, now_at
where sent and event_ts >= as_of - interval 7 days
order by event_ts desc, patient_id, rule
limit 50
