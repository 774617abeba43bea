"""Column helpers that stay inside the JVM, and the NumPy block helpers."""
