"""Column expressions: class rules, filters, metrics, exact rounding."""
