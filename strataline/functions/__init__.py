"""Builders of columns: pure, composable, all inside the JVM."""
