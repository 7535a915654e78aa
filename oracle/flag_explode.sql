select patient_id, event_time, unnest(flags) as flag from vitals
