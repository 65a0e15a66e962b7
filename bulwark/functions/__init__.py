"""Column expressions: they add no shuffle and stay inside the JVM."""
