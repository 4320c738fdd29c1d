"""The layers: silver, star schema, serving views, dashboards."""
