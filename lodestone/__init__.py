"""lodestone: star-schema analytics as Spark DataFrame plans.

Subpackages
-----------
sources    table loading, inline rows, derived datasets (layouts, snapshots)
functions  column-level helpers (PostgreSQL-compatible string/date/number rules)
operators  reusable DataFrame operators (joins, aggregates, windows, state, quality)
plans      parametric reports and the registry of named queries
streaming  incremental (micro-batch) drivers for the batch load jobs
"""

from lodestone.session import get_session, scale_conf, scratch_dir

__all__ = ["get_session", "scale_conf", "scratch_dir"]
