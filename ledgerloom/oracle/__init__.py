"""DuckDB SQL that computes each registered query a second, independent way."""
