select patient_id, heart_rate, systolic_bp, diastolic_bp, spo2, temperature, resp_rate, event_time, is_abnormal
from vitals
qualify row_number() over (partition by patient_id order by event_time desc, trace_id desc) = 1
