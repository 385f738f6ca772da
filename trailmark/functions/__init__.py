"""Column-level helpers: calendar periods, guarded arithmetic, distribution functions."""
