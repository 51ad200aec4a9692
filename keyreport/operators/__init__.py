"""DataFrame → DataFrame operators: keyed aggregates, co-group and union,
limits and user functions."""
