select distinct patient_id, device_id, event_time from readings
