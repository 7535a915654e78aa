select '2024-02-01' as run_date, patient_id, split,
       count(distinct time_bucket(interval 1 hour, event_time)) as feature_rows, max(heart_rate) as max_hr
from readings join split using (patient_id) group by 2, 3
