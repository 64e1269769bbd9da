"""The operators run over the driver's tables, each beside an SQL statement of the same result."""
