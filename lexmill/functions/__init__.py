"""Column expressions: every helper takes columns and returns a column, inside codegen."""
