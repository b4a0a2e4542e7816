"""Column-level building blocks: names, times, indicators, fixed values."""
