select * exclude (event_time, trace_id) from (
  select * from (select patient_id, device_id, date_trunc('second', event_time) as at_ts, round(heart_rate, 0) as hr_now,
       round(lag(heart_rate) over w, 0) as hr_prev, round(lead(heart_rate) over w, 0) as hr_next,
       round(heart_rate - lag(heart_rate) over w, 1) as delta,
       round((heart_rate - lag(heart_rate) over w) * 100.0::double
             / greatest(lag(heart_rate) over w, 1e-9::double), 2) as pct_change,
       event_time, trace_id
from readings
window w as (partition by device_id order by event_time, trace_id)) where abs(delta) >= 5
  order by patient_id, device_id, event_time, trace_id limit 30)
