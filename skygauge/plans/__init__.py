"""Named queries over a folder of Parquet tables, each with the SQL that states its result."""

from skygauge.plans.registry import ORACLES, QUERIES
from skygauge.plans import (  # noqa: F401
    advance, cleaning, evaluation, labelling, learning, refresh, serving, storage, streams, summaries, windows,
)

__all__ = ["ORACLES", "QUERIES"]
