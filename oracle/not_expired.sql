select patient_id, event_time, expires_at
from (select patient_id, max(event_time) as event_time,
             floor(epoch_us(max(event_time)) / 1000000)::bigint + 172800 as expires_at
      from readings group by 1), now_at
where expires_at > floor(epoch_us(as_of) / 1000000)::bigint
