"""Geodata tile pyramids and corpus operators on Spark."""
