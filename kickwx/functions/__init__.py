"""Column expressions shared by the models and queries (all JVM-side built-ins)."""
