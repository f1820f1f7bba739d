"""Column functions: `fn(column, ...) -> Column`, all built from JVM-side expressions."""
