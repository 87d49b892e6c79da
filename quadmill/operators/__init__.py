"""Operators: lazy, DataFrame in and DataFrame out."""
