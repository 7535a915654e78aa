select distinct patient_id from readings where patient_id not in (select patient_id from listed)
