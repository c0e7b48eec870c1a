"""Column expressions.  All of them stay inside generated code: no UDFs."""
