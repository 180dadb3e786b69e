"""strata: layered (bronze -> silver -> gold) analytics as Spark DataFrame operators.

Every operator is a function DataFrame -> DataFrame built from built-in Spark
expressions, with keys and columns passed as parameters. Nothing here owns a
SparkSession, collects data to the driver, or runs per-row Python.
"""

from strata.session import build_session, scratch_path, shuffle_sizing

__all__ = ["build_session", "scratch_path", "shuffle_sizing"]
