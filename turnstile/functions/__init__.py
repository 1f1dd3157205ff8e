"""Column functions: each takes Columns and returns a Column, all inside the JVM."""
