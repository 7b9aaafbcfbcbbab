"""Column expressions. All of them are built-in Spark functions; there are no Python UDFs."""
