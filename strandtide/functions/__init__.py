"""Column expressions: no I/O, no actions."""
