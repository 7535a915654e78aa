, marked as (
  select *, heart_rate >= 120 as high,
         coalesce(lag(heart_rate >= 120) over w
                  and epoch_us(event_time) - epoch_us(lag(event_time) over w) <= 86400000000, false) as continues
  from readings
  window w as (partition by patient_id order by event_time, trace_id)
),
numbered as (
  select *, sum((high and not continues)::int) over (partition by patient_id order by event_time, trace_id
                                                    rows between unbounded preceding and current row) as run
  from marked
),
runs as (
  select *, min(event_time) over (partition by patient_id, run) as run_start from numbered where high
),
sustained as (
  select patient_id,
         'A-' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || 'Z-HR_SUSTAINED_HIGH' as alert_id,
         'HR_SUSTAINED_HIGH' as rule, 'HR >= 120 for >= 30 s' as description, 'HIGH' as severity,
         heart_rate as "value", 120::double as threshold, event_time as event_ts, run_start
  from runs
  where epoch_us(event_time) - epoch_us(run_start) >= 30000000
  qualify row_number() over (partition by patient_id, run order by event_time, trace_id) = 1
)
select sustained.* exclude (description) from sustained, closed_at where event_ts <= passed
