"""Research-grant analytics as Spark DataFrame functions."""
