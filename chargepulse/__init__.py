"""chargepulse: recharge / top-up message analytics on Spark.

Messages (JSON strings, one per record) are parsed with ``from_json``, gated,
cleaned, joined to a province dimension, and rolled up into KPIs.  Every KPI
is a plain ``DataFrame -> DataFrame`` function, so the same code serves batch
tables and Structured Streaming micro-batches.
"""

from chargepulse.session import get_session, use_utc, work_dir

__all__ = ["get_session", "use_utc", "work_dir"]
