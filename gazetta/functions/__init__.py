"""Column functions: text rules, vocabularies, small formulas."""
