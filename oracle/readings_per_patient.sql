select patient_id, count(*) as readings from readings group by 1
