"""Column functions; all are compositions of built-in expressions."""
