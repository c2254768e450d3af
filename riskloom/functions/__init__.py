"""Column-level building blocks; nothing here needs a session or triggers a job."""
