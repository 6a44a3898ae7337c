"""Table operators: cleaning, history aggregates, splits, encoders, exploration,
multivalent columns, pooling and metrics.  All are DataFrame -> DataFrame."""
