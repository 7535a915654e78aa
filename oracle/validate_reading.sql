select "recordId", problem from records
