"""Column-expression helpers (all JVM-side built-ins) and the small Avro codec."""
