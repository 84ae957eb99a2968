"""Column-level building blocks: everything here returns a native Spark ``Column``."""
