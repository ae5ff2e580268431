"""Column functions; all but ``text.normalize_exact`` stay in the JVM."""
