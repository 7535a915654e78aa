select window_start::date::varchar as day, count(*) as windows,
       sum(reading_count + case when window_start::date between date '2024-01-05' and date '2024-01-14'
                                then 0 else 1000 end)::bigint as readings,
       max(max_heart_rate) as max_hr
from vitals_1m group by 1
