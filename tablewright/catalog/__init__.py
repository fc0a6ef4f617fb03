"""Named queries over the tables of a data folder, each with its SQL twin where SQL can say it."""

from tablewright.catalog import (  # noqa: F401  (modules register their queries)
    cleaning,
    evaluation,
    features,
    files,
    models,
    profiling,
    splitting,
)
from tablewright.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
