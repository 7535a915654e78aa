select patient_id, event_time, heart_rate, spo2, systolic_bp from readings
qualify row_number() over (partition by patient_id order by event_time desc, trace_id desc) = 1
