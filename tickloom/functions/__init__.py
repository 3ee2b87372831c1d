"""Column functions; all built-in expressions, nothing leaves the JVM."""
