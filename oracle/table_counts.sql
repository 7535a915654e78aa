select 'patients' as table_name, count(*) as rows from patients
union all select 'vitals', count(*) from readings
union all select 'vitals_1m', count(*) from vitals_1m
union all select 'vitals_hop_1m', count(*) from vitals_hop_1m
