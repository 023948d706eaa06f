"""Column functions: everything here is ``Column -> Column`` and runs in the JVM."""
