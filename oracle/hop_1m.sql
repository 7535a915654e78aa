select window_start, window_end, patient_id, round(avg_heart_rate, 6) as avg_heart_rate,
       max_heart_rate, min_spo2, reading_count
from vitals_hop_1m
