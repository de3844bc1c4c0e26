"""Column functions: JSON values, clock text, decimals, vehicle metrics."""
