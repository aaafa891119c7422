"""The driver's tables bound to the operators' inputs, and the same inputs as DuckDB SQL."""
