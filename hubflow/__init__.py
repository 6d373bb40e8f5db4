"""hubflow — travel-time and hub-network analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function (usable with ``df.transform``)
planned by Catalyst.  Sub-packages:

* ``sources``   — readers / writers, fixture views, persisted hub and model stores
* ``functions`` — reusable column expressions (safe division, risk rules, hashing)
* ``operators`` — cleaning, profiling, joins, graph, features, preprocessing, ML, scoring, ops
* ``plans``     — end-to-end compositions (processed build, hub tables, training, batch scoring)
* ``streaming`` — Structured Streaming scoring and windowed risk alerts
"""

from hubflow.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
