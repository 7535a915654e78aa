, latest as (
  select * from vitals
  qualify row_number() over (partition by patient_id order by event_time desc, trace_id desc) = 1
)
select q.patient_id, l.heart_rate, l.systolic_bp, l.diastolic_bp, l.spo2, l.temperature,
       l.resp_rate, l.event_time, l.is_abnormal,
       (case when not regexp_full_match(q.patient_id, '[A-Za-z0-9][A-Za-z0-9_.-]{0,63}') then 400
             when l.patient_id is not null then 200 else 404 end)::bigint as status
from requests q left join latest l using (patient_id)
