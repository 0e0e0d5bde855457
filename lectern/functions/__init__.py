"""Column expressions. Each one stays inside generated code; none is a UDF."""
