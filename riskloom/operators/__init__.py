"""DataFrame operators: lazy, built from native Spark expressions."""
