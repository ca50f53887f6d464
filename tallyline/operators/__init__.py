"""DataFrame -> DataFrame operators: clean, enrich, validate, analytics, table."""
