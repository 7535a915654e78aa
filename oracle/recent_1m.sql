select patient_id, window_start, round(avg_heart_rate, 6) as avg_heart_rate, max_heart_rate
from vitals_1m, now_at
where window_start >= as_of - interval 60 minutes
