select s.* from (select time_bucket(interval 1 hour, event_time) as window_start,
       time_bucket(interval 1 hour, event_time) + interval 1 hour as window_end,
       patient_id, round(avg(heart_rate), 6) as avg_heart_rate, max(heart_rate) as max_heart_rate,
       min(spo2) as min_spo2, max(systolic_bp) as max_systolic_bp, count(*) as reading_count
from readings group by 1, 2, 3) s, closed_at where window_end <= passed
