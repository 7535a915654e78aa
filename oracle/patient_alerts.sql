, newest as (
  select *, row_number() over (partition by patient_id order by alert_id desc) as position from alerts
),
asked as (
  select 'P' || lpad(c_custkey::varchar, greatest(6, length(c_custkey::varchar))::int, '0') as patient_id,
         case c_custkey % 6 when 0 then '5' when 1 then '1000' when 2 then 'abc' when 4 then '0' when 5 then ' 7 ' end as limit_text,
         case c_custkey % 6 when 0 then 5 when 1 then 100 when 4 then 1 when 5 then 7 else 10 end as n
  from customer
)
select patient_id, limit_text, position, alert_id, rule, "value"
from asked join newest using (patient_id) where position <= n
