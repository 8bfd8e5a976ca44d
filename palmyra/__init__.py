"""palmyra: plantation analytics on Spark DataFrames.

Layout:
  functions/  column expressions (clamp, deficit, guarded division, periods)
  operators/  reusable operators (capped balance, top-1, forward fill,
              proration, table refresh, size-checked broadcast)
  plans/      the jobs' logical plans (rainfall, BJR, weighbridge)
  sources/    warehouse schemas, loading, versioned publishing
  streaming/  the monthly update driven by arriving readings
"""

from palmyra.session import get_session  # noqa: F401

__all__ = ["get_session"]
