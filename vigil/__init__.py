"""vigil: sensor anomaly detection and predictive maintenance on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark's
own DataFrame operators (windows, aggregates, joins), so Catalyst plans the
whole chain.  Sub-packages:

``sources``    readers, writers and the stand-in mapping of the test tables
``functions``  column-level helpers (scaling, bit tests, buckets, rounding)
``operators``  grid / blocks / nulls / aggregates / anomaly / correlation /
               alarms / learn / setops
``plans``      composite chains and the registered query catalog
"""

from vigil.config import Roles, Settings  # noqa: F401
from vigil.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["Roles", "Settings", "get_session", "checkpoint_dir"]
