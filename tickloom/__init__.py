"""A market-data analytics engine on PySpark: tables, queries, operators, writers, quality, streams."""
