"""Queries over the test tables, and the same results in DuckDB SQL."""
