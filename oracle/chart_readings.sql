select date_trunc('minute', window_start) as minute, patient_id, sum(reading_count)::bigint as total_readings from vitals_1m group by 1, 2
