"""Column expressions: rule predicates and typed conversions."""
