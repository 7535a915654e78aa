select patient_id, split from split
