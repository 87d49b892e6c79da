"""Readers: text points, rasters, tiles, lists."""
