select date_trunc('minute', window_start) as minute, patient_id,
       round(avg(avg_heart_rate), 6) as avg_hr, max(max_heart_rate) as max_hr
from vitals_1m group by 1, 2
