select patient_id, first_name, gender, birth_date::varchar as birth_date, state from patients
