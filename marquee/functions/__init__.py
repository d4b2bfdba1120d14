"""Column expressions: typing, measures, predicates and labels."""
