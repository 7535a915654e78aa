, gaps as (
  select patient_id, lag(event_time) over w as gap_start, event_time as gap_end,
         (epoch_us(event_time) - epoch_us(lag(event_time) over w)) / 1000000.0::double as gap_seconds
  from readings window w as (partition by patient_id order by event_time, trace_id)
)
select * from gaps where gap_seconds > 86400
