select a.patient_id, a.event_time, a.trace_id, a.heart_rate,
       round(sum(b.heart_rate::decimal(22, 12))::double / count(*), 6) as rolling_avg_hr
from readings a join readings b on a.patient_id = b.patient_id
 and b.event_time between a.event_time - interval 1 hour and a.event_time
group by 1, 2, 3, 4
