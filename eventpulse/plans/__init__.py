"""Models built from the operators: staging, marts, dashboard tables, the daily run."""
