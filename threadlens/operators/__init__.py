"""Batch operators, one module per product.  Each function maps DataFrames to
a DataFrame and leaves physical planning to Catalyst and AQE."""
