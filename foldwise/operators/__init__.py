"""Feature stages and relational building blocks (state tables, quantiles, ranking, kNN, metrics)."""
