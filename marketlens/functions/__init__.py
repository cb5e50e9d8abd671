"""Column expressions. Everything here returns a Column and runs in the JVM."""
