"""Column functions: null-safe conditions and array steps."""
