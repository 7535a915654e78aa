select patient_id, alert_id, rule, severity, "value", threshold,
       strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as event_ts,
       'Vitals alert: ' || rule as subject
from alerts
where event_id % 5 < 4 and sent is not true and event_id % 7 <> 0
