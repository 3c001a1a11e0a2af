"""Table operators: reshape, series, neighbours, introspection and checks."""
