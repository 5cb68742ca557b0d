"""Column functions; every one is built from Spark SQL expressions and stays in the JVM."""
