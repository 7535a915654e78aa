select window_start, window_end, patient_id, round(avg_heart_rate, 6) as avg_heart_rate,
       max_heart_rate, min_spo2, max_systolic_bp, reading_count
from vitals_1m order by window_start, patient_id limit 5
