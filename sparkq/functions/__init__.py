"""Column expressions that run inside whole-stage code generation."""
