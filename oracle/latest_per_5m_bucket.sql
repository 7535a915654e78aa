select patient_id, time_bucket(interval 5 minutes, event_time) as bucket_ts, heart_rate as last_hr, event_time
from readings
qualify row_number() over (partition by patient_id, time_bucket(interval 5 minutes, event_time)
                           order by event_time desc, trace_id desc) = 1
