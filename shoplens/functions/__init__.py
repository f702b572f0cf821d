"""Column-expression helpers (pure ``Column -> Column``, JVM-side)."""
