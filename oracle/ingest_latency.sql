select event_time::date::varchar as day, count(*) as readings,
       round(quantile_cont((event_id * 7919) % 600, 0.95), 3) as p95_seconds,
       quantile_cont((event_id * 7919) % 600, 0.95) <= 60 as within_target
from readings group by 1
