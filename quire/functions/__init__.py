"""Column-building functions (JVM-side expressions)."""
