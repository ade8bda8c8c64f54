"""Cleaning rules as Column expressions; everything runs inside the JVM."""
