, t as (select count(*) as windows, count(distinct patient_id) as patients,
               sum(reading_count)::bigint as sampled_readings, min(window_start) as lo, max(window_end) as hi
        from vitals_1m),
h as (select count(*) as windows, count(distinct patient_id) as patients,
             sum(reading_count)::bigint as sampled_readings, min(window_start) as lo, max(window_end) as hi
      from vitals_hop_1m)
select 'tumbling 1m' as windowing, *, 1::double as overlap_factor from t
union all
select 'hop 30s/1m', *, round(windows / (select windows from t)::double, 2) from h
