"""Column-to-column functions. Nothing here triggers a job."""
