"""Column -> Column helpers; all of them run inside the JVM."""
