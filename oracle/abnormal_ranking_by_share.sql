, per_patient as (
  select patient_id, count(*) filter (flagged_readings > 0) as abnormal_minutes,
         round(100.0::double * count(*) filter (flagged_readings > 0) / count(*), 1) as abnormal_share_pct,
         sum(flagged_readings)::bigint as abnormal_readings
  from minutes group by 1
)
select patient_id, abnormal_minutes, abnormal_readings, abnormal_share_pct,
       rank_by_share, rank_by_volume
from (select *, dense_rank() over (order by abnormal_share_pct desc) as rank_by_share,
             rank() over (order by abnormal_readings desc) as rank_by_volume
      from per_patient)
