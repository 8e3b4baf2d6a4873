"""Column-returning helpers: every one builds a native Spark expression so
it stays inside whole-stage codegen (no Python UDF)."""
