"""Sinks: table writes, partitioned/clustered facts, per-group exports."""
