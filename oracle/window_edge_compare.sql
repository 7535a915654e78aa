, m as (select date_trunc('minute', as_of) as minute from now_at)
select 'tumbling' as win, window_start, window_end, count(distinct patient_id) as patients,
       round(avg(avg_heart_rate), 1) as avg_hr
from vitals_1m, m where window_start = minute group by 1, 2, 3
union all
select 'hop', window_start, window_end, count(distinct patient_id), round(avg(avg_heart_rate), 1)
from vitals_hop_1m, m
where window_start between minute - interval 30 seconds and minute + interval 30 seconds
group by 1, 2, 3
