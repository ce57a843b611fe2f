"""Column functions; all of them stay in the JVM unless their module says otherwise."""
