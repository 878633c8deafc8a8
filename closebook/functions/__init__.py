"""Column expressions and small literal tables; everything here stays inside code generation."""
