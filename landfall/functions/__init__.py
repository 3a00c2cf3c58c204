"""Column -> Column helpers. Everything here stays inside JVM code generation."""
