"""The package run on the given test tables, with DuckDB SQL to check it."""
