"""Column rules and predicates."""
