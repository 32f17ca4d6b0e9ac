"""Card-transaction analytics as plain Spark DataFrame functions."""
