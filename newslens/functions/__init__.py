"""Column -> Column building blocks; everything here stays JVM-side."""
