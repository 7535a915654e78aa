select patient_id from patients
