select patient_id, event_time, trace_id, heart_rate,
       ntile(10) over (partition by patient_id order by heart_rate, event_time, trace_id) as hr_decile
from readings
