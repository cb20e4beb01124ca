"""Column -> Column building blocks. No function here starts a Spark job."""
