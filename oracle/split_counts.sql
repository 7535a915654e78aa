select split, count(*) as patients from split group by 1
