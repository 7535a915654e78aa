select patient_id, event_time,
       greatest(30, least(220, heart_rate)) as heart_rate,
       greatest(60, least(240, systolic_bp)) as systolic_bp,
       greatest(40, least(160, diastolic_bp)) as diastolic_bp,
       greatest(70, least(100, spo2)) as spo2,
       greatest(32, least(42, temperature)) as temperature,
       greatest(6, least(60, resp_rate)) as resp_rate,
       (heart_rate not between 30 and 220)::bigint + (systolic_bp not between 60 and 240)::bigint
       + (diastolic_bp not between 40 and 160)::bigint + (spo2 not between 70 and 100)::bigint
       + (temperature not between 32 and 42)::bigint + (resp_rate not between 6 and 60)::bigint
         as measures_out_of_range
from readings
