"""Column-expression helpers (JVM-side, codegen'd) and calendar tables."""
