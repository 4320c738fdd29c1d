"""Independent SQL for every query, written against the source tables."""
