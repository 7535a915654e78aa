select patient_id, heart_rate as hr, event_time, rk
from (select *, rank() over (partition by patient_id order by heart_rate desc) as rk from readings)
where rk <= 3
