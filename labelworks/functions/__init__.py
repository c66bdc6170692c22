"""Column expressions: scalar functions and metric aggregates."""
