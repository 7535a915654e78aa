select case when event_id % 5 < 2 then 'INSERT' when event_id % 5 < 4 then 'MODIFY' else 'REMOVE' end as op,
       patient_id, alert_id, rule, severity, "value",
       case when "value" = floor("value") then 'int' else 'float' end as value_kind,
       threshold, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as event_ts,
       sent::varchar as sent
from alerts
