"""Column expressions. Everything here stays in the JVM; no Python runs per row."""
