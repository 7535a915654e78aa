select event_time::date::varchar as day, count(*) as readings, sum(heart_rate::decimal(12, 3))::double as hr_sum
from readings group by 1
