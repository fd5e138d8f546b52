"""DataFrame -> DataFrame operators with explicit column names."""
