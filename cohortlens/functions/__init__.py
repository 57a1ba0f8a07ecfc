"""Column-to-Column building blocks, all JVM-side expressions."""
