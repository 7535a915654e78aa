select "recordId", problem from records where problem is not null
