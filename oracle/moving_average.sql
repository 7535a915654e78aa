select * exclude (event_time, trace_id) from (
  select patient_id, device_id, date_trunc('second', event_time) as at_ts, round(heart_rate, 0) as hr,
       round(avg(heart_rate) over (w rows between 2 preceding and current row), 1) as hr_ma3_trailing,
       round(avg(heart_rate) over (w rows between 2 preceding and 2 following), 1) as hr_ma5_centred,
       round(min(spo2) over (w rows between 2 preceding and current row), 1) as spo2_trailing_min,
       event_time, trace_id
from readings
window w as (partition by patient_id order by event_time, trace_id)
  order by patient_id, device_id, event_time, trace_id limit 25)
