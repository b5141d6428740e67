"""Composed jobs (W1-W4) and the registered query set over the driver's test tables."""
