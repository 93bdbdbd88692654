"""Every operator of the library as a query on the given tables, and the same in SQL."""
