select patient_id, event_time, ingestion_time, trace_id,
       (epoch_us(wm) - epoch_us(closes)) / 1000000.0::double as seconds_late
from (
  select *, time_bucket(interval 1 minute, event_time) + interval 1 minute as closes,
         max(event_time) over (order by ingestion_time, trace_id
                               rows between unbounded preceding and 1 preceding) - interval 10 seconds as wm
  from readings)
where closes <= wm
