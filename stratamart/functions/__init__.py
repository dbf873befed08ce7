"""Column functions: time, money, metrics. All are built-in Spark expressions."""
