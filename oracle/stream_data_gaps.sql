, gaps as (
  select patient_id, lag(event_time) over w as gap_start, event_time as gap_end,
         (epoch_us(event_time) - epoch_us(lag(event_time) over w)) / 1000000.0::double as gap_seconds
  from readings window w as (partition by patient_id order by event_time, trace_id)
)

, opened as (
  select patient_id, max(event_time) as gap_start from readings, closed_at where event_time <= passed group by 1
)
select patient_id, gap_start, gap_end from gaps, closed_at where gap_seconds > 86400 and gap_end <= passed
union all
select patient_id, gap_start, null from opened, closed_at where gap_start + interval 1 day < passed
