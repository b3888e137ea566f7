"""DuckDB SQL that re-derives every registered query independently (correctness oracle)."""
