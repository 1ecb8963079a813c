"""Column-level helpers: time, numbers and charging rules."""
