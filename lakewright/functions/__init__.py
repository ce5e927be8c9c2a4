"""Column builders. All are built-in expressions, so they stay inside code generation."""
