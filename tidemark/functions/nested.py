"""Nested-payload access with defaults (maps and structs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def get_or(map_col, key: str, default=None) -> Column:
    """``map[key]`` with a default for a missing key or a null map (never raises under ANSI)."""
    v = F.try_element_at(_c(map_col), F.lit(key))
    return v if default is None else F.coalesce(v, F.lit(default))


def vote_counts(votes_map, up_key: str = "UPVOTES", down_key: str = "DOWNVOTES") -> Column:
    """(positive, negative) vote counts from a map: missing map, key or null -> 0; integers."""
    m = _c(votes_map)

    def one(k):
        return F.coalesce(F.try_element_at(m, F.lit(k)).try_cast("double").try_cast("int"), F.lit(0))

    return F.struct(one(up_key).alias("votes_positive"), one(down_key).alias("votes_negative"))


__all__ = ["get_or", "vote_counts"]
