"""Column expressions and kernels."""
