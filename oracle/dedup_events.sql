select * exclude (event_id) from (
  select * from readings
  union all
  select * replace (ingestion_time + interval 5 seconds as ingestion_time) from readings where event_id % 50 = 0)
qualify row_number() over (partition by patient_id, device_id, event_time order by ingestion_time, trace_id) = 1
