"""``DataFrame -> DataFrame`` transforms; none of them triggers a job."""
