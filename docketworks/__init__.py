"""Case analytics on Spark: raw events, clean records, star schema, dashboards."""
