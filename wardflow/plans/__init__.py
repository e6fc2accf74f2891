"""Reports and end-to-end jobs."""
