select count(*) as rows, round(avg(heart_rate), 6) as avg_hr from readings
