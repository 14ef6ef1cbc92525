"""Column-level helpers; every one returns a Spark ``Column``."""
