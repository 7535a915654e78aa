select patient_id, event_time, array_to_string(flags, ',') as abnormal_flags, is_abnormal from vitals
