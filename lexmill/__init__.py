"""lexmill: a PySpark analytics engine for public court-case records."""
