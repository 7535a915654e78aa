select coalesce(a.day, b.day, c.day)::varchar as day, coalesce(readings, 0) as readings,
       coalesce(alerts_written, 0) as alerts_written, coalesce(alerts_sent, 0) as alerts_sent,
       coalesce(dropped, 0) as dropped
from (select event_time::date as day, count(*) as readings from readings group by 1) a
full join (select event_ts::date as day, count(*) as alerts_written,
                  count(*) filter (sent) as alerts_sent from alerts group by 1) b on a.day = b.day
full join (select ingestion_time::date as day, count(*) filter (problem is not null) as dropped
           from records group by 1) c on coalesce(a.day, b.day) = c.day
