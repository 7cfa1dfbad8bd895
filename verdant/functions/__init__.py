"""Column builders (no DataFrame in, Column out)."""
