"""aerolith — a Spark-native medallion warehouse for sensor and air-quality feeds.

Raw JSON feeds land as Bronze tables, are cleaned into Silver, and are modelled
into a Kimball star schema (Gold) with static, type-1 and type-2 dimensions,
fact tables, streaming one-minute aggregates and analytic marts. Every operator
is a ``DataFrame -> DataFrame`` function built from Spark SQL expressions.
"""

from aerolith.session import build_session, configure, scratch_root

__all__ = ["build_session", "configure", "scratch_root"]
