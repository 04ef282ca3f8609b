"""Small shared Column helpers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateau.config import INTERACTION_WEIGHTS


def literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def weight_of(event: Column, weights: dict[str, float] | None = None,
              default: float | None = None) -> Column:
    """Engagement weight of an event name; unknown -> ``default`` (NULL if None)."""
    w = F.try_element_at(literal_map(weights or INTERACTION_WEIGHTS), event).cast("double")
    return w if default is None else F.coalesce(w, F.lit(float(default)))


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a timestamp (NTZ read as UTC wall time)."""
    return F.unix_seconds(ts.cast("timestamp"))


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
