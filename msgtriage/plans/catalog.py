"""The query catalog: importing this module registers every query.

Every query reads the given tables (or data Spark derives from them) in full.
Names say what the query computes; ``Query.ops`` lists the survey operator
ids it covers. Computed columns carry the same alias in Spark and in the
DuckDB oracle; doubles are rounded to 6 places and integer aggregates are
BIGINT on both sides.
"""

from __future__ import annotations

from msgtriage.plans import (  # noqa: F401
    queries_etl,
    queries_io,
    queries_lexicon,
    queries_ml,
    queries_sampling,
    queries_stages,
    queries_stream,
    queries_text,
    queries_vectors,
)
from msgtriage.plans.registry import REGISTRY, Query, register  # noqa: F401
