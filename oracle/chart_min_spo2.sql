select date_trunc('minute', window_start) as minute, patient_id, min(min_spo2) as min_spo2 from vitals_1m group by 1, 2
