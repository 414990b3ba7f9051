"""Custom operators composed from DataFrame primitives."""
