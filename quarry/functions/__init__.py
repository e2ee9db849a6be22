"""Column-expression helpers (JVM-side built-ins only) and small stats kernels."""
