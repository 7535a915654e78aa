select flag, count(*) as occurrences
from (select event_time, unnest(flags) as flag from vitals), now_at
where event_time >= as_of - interval 24 hours
group by 1
