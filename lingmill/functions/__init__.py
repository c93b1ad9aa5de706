"""Column functions: everything here is built from JVM-side expressions."""
