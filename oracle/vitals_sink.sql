select * exclude (event_id, flags), array_to_string(flags, ',') as abnormal_flags from vitals
