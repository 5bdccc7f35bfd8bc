"""Reports, alerts and the three pipelines."""
