select patient_id, bucket_ts, readings,
       (sum(readings) over (partition by patient_id order by bucket_ts
                            rows between unbounded preceding and current row))::bigint as cumulative,
       round(100.0::double * sum(readings) over (partition by patient_id order by bucket_ts
                            rows between unbounded preceding and current row)
             / sum(readings) over (partition by patient_id), 1) as pct_of_session
from minutes
order by patient_id, bucket_ts limit 25
