select patient_id, event_time, is_abnormal from vitals
