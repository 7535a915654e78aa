, scored as (select patient_id, event_time, unnest(flags) as flag from vitals),
flag_minutes as (
  select patient_id, date_trunc('minute', event_time) as bucket_ts, count(*) as flagged_readings
  from scored group by 1, 2
),
per_patient as (
  select patient_id, count(flagged_readings) as abnormal_minutes,
         round(100.0 * count(flagged_readings) / count(distinct bucket_ts), 1)::double as abnormal_share_pct,
         sum(flagged_readings)::bigint as abnormal_readings
  from flag_minutes group by 1
)
select patient_id, abnormal_minutes, abnormal_readings, abnormal_share_pct,
       rank_by_share, rank_by_volume
from (select *, dense_rank() over (order by abnormal_share_pct desc) as rank_by_share,
             rank() over (order by abnormal_readings desc) as rank_by_volume
      from per_patient)
