"""Column functions (JVM-side expressions)."""
