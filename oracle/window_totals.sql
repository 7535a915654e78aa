select count(*) as windows, coalesce(sum(reading_count), 0)::bigint as readings from vitals_1m
