select patient_id, event_time, heart_rate as hr,
       rank() over (partition by patient_id order by heart_rate desc) as rk,
       dense_rank() over (partition by patient_id order by heart_rate desc) as dense_rk
from readings
