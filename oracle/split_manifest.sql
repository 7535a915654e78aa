select '2024-02-01' as run_date, count(*) as feature_count, 'patient' as split_by,
       count(*) filter (split = 'train') as train, count(*) filter (split = 'val') as val,
       count(*) filter (split = 'test') as test
from split
