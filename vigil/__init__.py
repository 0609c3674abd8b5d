"""vigil — transaction-risk analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL,
Spark ML and Structured Streaming primitives. Sub-packages:

- ``sources``    readers, driver-table adapters and sinks
- ``functions``  column expressions (flags, bands, bins, trade parsing)
- ``operators``  joins, checks, profiles, drift, features, evaluation, training
- ``plans``      compositions (training/evaluation runs, drift job, query registry)
- ``streaming``  Structured Streaming scorers and stateful drift
"""

from vigil.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
