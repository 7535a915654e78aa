select a.patient_id, a.event_time, a.trace_id, a.heart_rate,
       round(regr_slope(b.heart_rate, (epoch_us(b.event_time) - epoch_us(a.event_time)) / 60000000.0::double), 6) as slope
from readings a join readings b on a.patient_id = b.patient_id
 and b.event_time between a.event_time - interval 15 minutes and a.event_time
group by 1, 2, 3, 4
