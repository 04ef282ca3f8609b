"""Column -> Column expressions. All are built-in Spark expressions (codegen, no UDF)."""
