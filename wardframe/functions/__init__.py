"""Column expressions and fixed code lists shared by the plans."""
