"""The operators bound to the test tables, and the same answers in DuckDB SQL."""
