, stats as (
  select patient_id, avg(heart_rate) as mu, stddev_samp(heart_rate) as sd from readings group by 1
),
w as (
  select patient_id, time_bucket(interval 1 hour, event_time) as window_start,
         time_bucket(interval 1 hour, event_time) + interval 1 hour as window_end,
         sum(heart_rate::decimal(22, 12))::double / count(*) as avg_hr, max(heart_rate) as max_hr, min(heart_rate) as min_hr,
         quantile_cont(heart_rate, 0.95) as hr_p95, stddev_samp(heart_rate) as hr_std,
         avg(spo2) as avg_spo2, min(spo2) as min_spo2, bool_or(is_abnormal) as flagged
  from vitals group by 1, 2, 3
),
lookback as (
  select w.patient_id, w.window_end,
         regr_slope(heart_rate, (epoch_us(event_time) - epoch_us(w.window_end)) / 60000000.0::double) as slope_hr_15m,
         sum(heart_rate::decimal(22, 12))::double / count(*) as rolling_avg_hr_1h
  from w join readings r on r.patient_id = w.patient_id
   and r.event_time >= w.window_end - interval 1 day and r.event_time < w.window_end
  group by 1, 2
)
select w.patient_id, w.window_start, w.window_end,
       (date_part('year', w.window_start) - date_part('year', birth_date)
       - (strftime(w.window_start, '%m%d') < strftime(birth_date, '%m%d'))::int)::int as age_years, gender,
       round(avg_hr, 4) as avg_hr, max_hr, round(hr_p95, 4) as hr_p95, round(hr_std, 4) as hr_std,
       round(avg_spo2, 4) as avg_spo2, min_spo2, round(slope_hr_15m, 6) as slope_hr_15m,
       round(rolling_avg_hr_1h, 4) as rolling_avg_hr_1h,
       flagged or coalesce(greatest(abs(max_hr - mu), abs(min_hr - mu)) > 3 * sd, false) as is_anomaly,
       split
from w join lookback using (patient_id, window_end) join stats using (patient_id)
left join patients using (patient_id) join split using (patient_id)
