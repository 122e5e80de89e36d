"""ridestar: a ride-event analytics pipeline written as plain Spark DataFrame functions.

Layers: ``sources`` (scans and sinks), ``functions`` (column expressions),
``operators`` (reusable DataFrame -> DataFrame steps), ``plans`` (the models:
staging, star schema, marts, data quality, checks, gates) and ``streaming``
(the bronze archive job).
"""

__all__ = ["session", "spec"]
