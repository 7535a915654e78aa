select window_start, window_start + interval 1 hour as window_end, patient_id,
       round(avg(heart_rate), 6) as avg_heart_rate, max(heart_rate) as max_heart_rate,
       min(spo2) as min_spo2, count(*) as reading_count
from (select r.*, time_bucket(interval 30 minutes, event_time) - to_minutes(30 * k) as window_start
      from readings r, (select unnest([0, 1]) as k))
group by 1, 2, 3
