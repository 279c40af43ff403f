"""Column expressions: no Python runs per row in any of them."""
