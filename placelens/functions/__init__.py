"""Column expressions: text predicates, scaling, geometry."""
