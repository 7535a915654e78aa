select patient_id, date_trunc('minute', event_time) as bucket_ts, hour(event_time) as hour_of_day,
       isodow(event_time) as day_of_week, count(*) as readings,
       round(avg(heart_rate), 1) as avg_hr, min(spo2) as min_spo2, round(avg(systolic_bp), 1) as avg_sbp
from readings group by 1, 2, 3, 4
order by patient_id, bucket_ts limit 20
