"""contrail: Spark-native flight and aircraft-position analytics.

Every operator is a plain DataFrame / Spark SQL / pyspark.ml / Structured
Streaming expression. Column rules live in ``contrail.functions``; table
transforms, reports and checks in ``contrail.operators``; readers, writers
and the driver-table views in ``contrail.sources``; the named query registry
in ``contrail.plans``; stream jobs in ``contrail.streaming``.
"""

from contrail.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
