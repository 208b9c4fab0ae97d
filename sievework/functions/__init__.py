"""Column expressions; all of them are built-in JVM expressions, none is a Python UDF."""
