select round(avg(max_heart_rate), 6) as avg_max_hr from vitals_1m
