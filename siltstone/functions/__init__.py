"""Column -> Column helpers. Everything here stays inside the JVM expression engine."""
