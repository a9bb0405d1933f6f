"""Queries over the driver's tables: every operator applied to whole tables, beside DuckDB SQL of the same result."""
