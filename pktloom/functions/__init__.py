"""Column expressions, all evaluated on the JVM."""
