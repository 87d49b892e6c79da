"""Column functions: grid, geodesy, color, general math and strings."""
