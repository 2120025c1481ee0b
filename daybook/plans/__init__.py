"""Relations derived from the test tables, registered queries, their SQL, the refresh job."""
