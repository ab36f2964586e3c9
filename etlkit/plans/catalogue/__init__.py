"""Registered queries, each beside the SQL that must give the same rows."""

from etlkit.plans.catalogue import (  # noqa: F401
    aggregation,
    curation,
    quality,
    relational,
    scalars,
    storage,
    streams,
    windowing,
)
from etlkit.plans.catalogue.registry import ORACLES, QUERIES, Tables  # noqa: F401
