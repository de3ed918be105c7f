"""Column expressions with exact semantics; all built in."""
