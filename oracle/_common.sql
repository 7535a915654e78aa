with readings as (
  select event_id,
         'P' || lpad(user_id::varchar, greatest(6, length(user_id::varchar))::int, '0')    as patient_id,
         'bed-' || lpad(user_id::varchar, greatest(6, length(user_id::varchar))::int, '0') as device_id,
         ts                                       as event_time,
         ts + to_seconds((event_id * 7919) % 600) as ingestion_time,
         least(220::double, 60 + value)           as heart_rate,
         100::double + event_id % 61              as systolic_bp,
         60::double + event_id % 31               as diastolic_bp,
         100 - 0.125::double * json_extract_string(props, '$.k')::int as spo2,
         36 + 0.125::double * (event_id % 25)     as temperature,
         12::double + event_id % 19               as resp_rate,
         md5(event_id::varchar)                   as trace_id
  from events
),
vitals as (
  select *,
         list_filter([case when heart_rate >= 120 then 'HR_HIGH' end,
                      case when heart_rate >= 180 then 'CRITICAL_HR' end,
                      case when spo2 < 92 then 'SPO2_LOW' end,
                      case when systolic_bp >= 140 then 'BP_HIGH' end],
                     lambda x: x is not null) as flags,
         heart_rate >= 120 or spo2 < 92 or systolic_bp >= 140 as is_abnormal
  from readings
),
patients as (
  select 'P' || lpad(c_custkey::varchar, greatest(6, length(c_custkey::varchar))::int, '0') as patient_id,
         split_part(c_name, '#', 1) as first_name,
         split_part(c_name, '#', 2) as last_name,
         case c_custkey % 3 when 0 then 'M' when 1 then 'F' else 'NB' end as gender,
         (date '1940-01-01' + ((c_custkey * 97) % 25000)::int)::date as birth_date,
         n_name as city,
         r_name as state
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
),
listed as (select * from patients where right(patient_id, 1) <> '0'),
now_at as (select max(event_time) as as_of from readings),
vitals_1m as (
  select time_bucket(interval 1 minute, event_time) as window_start,
         time_bucket(interval 1 minute, event_time) + interval 1 minute as window_end,
         patient_id,
         avg(heart_rate) as avg_heart_rate,
         max(heart_rate) as max_heart_rate,
         min(spo2) as min_spo2,
         max(systolic_bp) as max_systolic_bp,
         count(*) as reading_count
  from readings
  group by 1, 2, 3
),
hopped as (
  select r.*, time_bucket(interval 30 seconds, event_time) - to_seconds(30 * k) as window_start
  from readings r, (select unnest([0, 1]) as k)
),
vitals_hop_1m as (
  select window_start, window_start + interval 1 minute as window_end, patient_id,
         avg(heart_rate) as avg_heart_rate,
         max(heart_rate) as max_heart_rate,
         min(spo2) as min_spo2,
         count(*) as reading_count
  from hopped
  group by 1, 2, 3
),
fired as (
  select *, 'HR_HIGH' as rule, 'heart rate >= 120' as description, 'HIGH' as severity,
         heart_rate as "value", 120::double as threshold
  from vitals where heart_rate >= 120
  union all
  select *, 'CRITICAL_HR', 'heart rate >= 180', 'CRITICAL', heart_rate, 180::double
  from vitals where heart_rate >= 180
  union all
  select *, 'SPO2_LOW', 'SpO2 < 92', 'HIGH', spo2, 92::double
  from vitals where spo2 < 92
  union all
  select *, 'BP_HIGH', 'systolic BP >= 140', 'HIGH', systolic_bp, 140::double
  from vitals where systolic_bp >= 140
),
alerts as (
  select patient_id,
         'A-' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || 'Z-' || rule as alert_id,
         rule, description, severity, "value", threshold,
         event_time as event_ts, false as resolved,
         case event_id % 3 when 1 then false when 2 then true end as sent,
         event_time as created_at, event_id
  from fired
  qualify row_number() over (partition by patient_id, event_time, rule order by trace_id) = 1
),
records as (
  select *, 'rec-' || event_id as "recordId",
         case event_id % 20
           when 0 then 'not a JSON object'
           when 1 then 'missing spo2'
           when 2 then 'not a number: heart_rate'
           when 3 then 'not a number: heart_rate'
           when 5 then 'not a JSON object'
           when 6 then 'not a JSON object'
           when 8 then 'not a number: spo2'
         end as problem
  from readings
),
accepted as (
  select "recordId", patient_id, device_id,
         strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as event_time,
         strftime(ingestion_time, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as ingestion_time,
         case when event_id % 20 = 7 then 1 else round(heart_rate, 3) end as heart_rate,
         systolic_bp,
         case when event_id % 20 = 4 then 0 else diastolic_bp end as diastolic_bp,
         spo2, temperature, resp_rate, trace_id
  from records
  where problem is null
),
ids as (
  select distinct patient_id, md5('42:' || patient_id) as h from readings
),
split as (
  select patient_id,
         case when rn <= floor(n * 0.7) then 'train'
              when rn <= floor(n * 0.7) + floor(n * 0.15) then 'val'
              else 'test' end as split
  from (select patient_id, row_number() over (order by h, patient_id) as rn,
               (count(*) over ())::double as n from ids)
),
minutes as (
  select patient_id, date_trunc('minute', event_time) as bucket_ts,
         sum(len(flags))::bigint as flagged_readings, count(*) as readings
  from vitals group by 1, 2
),
requests as (
  select c_custkey, 'P' || lpad(c_custkey::varchar, greatest(6, length(c_custkey::varchar))::int, '0') as patient_id from customer
  union all
  select c_custkey, 'P' || lpad(c_custkey::varchar, greatest(6, length(c_custkey::varchar))::int, '0') || ' !' from customer
  where c_custkey % 7 = 0
),
closed_at as (
  select date_trunc('milliseconds', as_of) - interval 10 seconds as passed from now_at
)
