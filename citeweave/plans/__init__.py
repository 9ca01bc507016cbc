"""Views over the test tables, composite jobs and the query catalogue."""
