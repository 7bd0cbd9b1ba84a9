"""Column expressions, window registry, feature naming and metric specs."""
