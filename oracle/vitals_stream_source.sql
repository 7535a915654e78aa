select * exclude (event_id) from readings
