"""Column expressions. All of them stay inside the JVM; there are no Python UDFs."""
