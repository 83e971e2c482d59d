"""Column -> Column functions. Nothing here triggers a job."""
