"""Plan-shaping helpers shared by the operators: skew handling, exact quantiles, checkpoints."""
