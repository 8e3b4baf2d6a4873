"""tessera — Spark-native analytics for a layered retail-payments lakehouse,
rule-based record scoring and survey-data cleaning.

Everything is expressed as DataFrame / SQL operations so Catalyst plans it and
the same code runs on a laptop sample or a cluster.
"""

from tessera.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
