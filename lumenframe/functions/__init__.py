"""Column expressions and the shared ordering / checkpoint helpers."""
