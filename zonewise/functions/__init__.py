"""Column functions; every one of them stays inside the JVM."""
