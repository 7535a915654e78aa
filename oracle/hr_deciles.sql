select patient_id, max(heart_rate) as peak_hr, max(hr_decile) as peak_decile
from (select *, ntile(10) over (partition by patient_id order by heart_rate, event_time, trace_id) as hr_decile
      from readings)
group by 1
