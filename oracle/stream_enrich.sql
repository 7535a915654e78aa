select r.patient_id, event_time, trace_id, heart_rate, gender, state
from readings r left join patients using (patient_id)
