"""Column builders: DataFrame-free expressions, JVM-side wherever Spark has a builtin."""
