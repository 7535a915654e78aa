select split, '2024-02-01' as run_date, count(distinct patient_id) as patients, count(*) as feature_rows
from vitals_1m join split using (patient_id) group by 1
