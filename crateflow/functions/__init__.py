"""Column -> Column builders and the few Arrow kernels Spark lacks."""
