"""Column expressions: everything here is built-in Spark and stays in the JVM."""
