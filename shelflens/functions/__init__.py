"""Column expressions, which stay inside the JVM, and small helpers."""
