select 'vitals' as table_name, count(*) as rows from readings
union all select 'vitals_1m', count(*) from vitals_1m, closed_at where window_end <= passed
union all select 'vitals_hop_1m', count(*) from vitals_hop_1m, closed_at where window_end <= passed
