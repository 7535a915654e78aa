select strftime(r.ingestion_time, '%Y') as year, strftime(r.ingestion_time, '%m') as month,
       strftime(r.ingestion_time, '%d') as day, printf('%02d', date_part('hour', r.ingestion_time)::int // 8 * 8) as hour, a.*
from accepted a join records r using ("recordId")
