"""Column builders. Every function here returns a native Spark ``Column`` (no Python UDFs)."""
