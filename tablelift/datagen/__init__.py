"""Synthetic test tables of any size, made by Spark from row numbers."""
