select patient_id, bucket_ts, flagged_readings from minutes where flagged_readings > 0
