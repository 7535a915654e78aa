select case when event_id % 10 = 0 then null else trace_id end as trace_id,
       case when event_id % 10 < 2 then null else heart_rate end as heart_rate,
       case when event_id % 10 < 2 then 'not a reading' end as problem
from readings
