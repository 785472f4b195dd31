"""Column expressions and Arrow-batched text kernels."""
