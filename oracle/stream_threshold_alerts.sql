select patient_id, alert_id, rule, description, severity, "value", threshold, event_ts, resolved,
       false as sent, created_at
from alerts
