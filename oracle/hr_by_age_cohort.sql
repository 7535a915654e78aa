, aged as (
  select r.patient_id, heart_rate, date_part('year', as_of::date) - date_part('year', birth_date)
       - (strftime(as_of::date, '%m%d') < strftime(birth_date, '%m%d'))::int as age
  from readings r join patients p using (patient_id), now_at
)
select case when age < 18 then '0-17' when age < 40 then '18-39' when age < 65 then '40-64' else '65+' end as age_band,
       count(distinct patient_id) as patients, count(heart_rate) as readings,
       round(sum(heart_rate::decimal(22, 12))::double / count(heart_rate), 4) as avg_hr,
       max(heart_rate) as max_hr
from aged group by 1
