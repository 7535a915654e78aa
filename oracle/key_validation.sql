select patient_id, regexp_full_match(patient_id, '[A-Za-z0-9][A-Za-z0-9_.-]{0,63}') as valid from requests
