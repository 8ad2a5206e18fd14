"""Dimensional analytics on PySpark: loading, star schema, insights, streams."""
