select "recordId", patient_id, device_id, event_time, trace_id, heart_rate, systolic_bp,
       diastolic_bp, spo2, temperature, resp_rate,
       heart_rate >= 120 or spo2 < 92 or systolic_bp >= 140 as is_abnormal
from accepted
