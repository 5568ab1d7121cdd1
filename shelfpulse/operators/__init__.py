"""DataFrame to DataFrame. Ranks and trends stage small aggregates they read twice."""
