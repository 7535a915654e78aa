select patient_id, event_time, trace_id from readings, now_at where event_time >= as_of - interval 14 days
