, stats as (select patient_id, avg(heart_rate) as mu, stddev_samp(heart_rate) as sd from readings group by 1),
labelled as (
  select patient_id, event_time, heart_rate, is_abnormal as rule_flag,
         coalesce(abs(heart_rate - mu) > 3 * sd, false) as outlier,
         is_abnormal or coalesce(abs(heart_rate - mu) > 3 * sd, false) as is_anomaly
  from vitals join stats using (patient_id)
)
select * from labelled
