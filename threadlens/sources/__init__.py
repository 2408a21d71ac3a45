"""Schemas and readers: raw JSON dumps, typed Parquet, feed pages, name lists,
and the mapping of the driver's ``events`` table onto the comment model."""
