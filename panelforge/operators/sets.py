"""Set operations and suffixed joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union aligned by column name; with ``allow_missing`` absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def left_join_suffixed(left: DataFrame, right: DataFrame, on: Sequence[str],
                       suffixes: tuple[str, str] = ("_prices", "_fin")) -> DataFrame:
    """Left join keeping all left rows; columns present on both sides (other
    than the keys) get the suffixes, as pandas ``merge`` does."""
    common = (set(left.columns) & set(right.columns)) - set(on)
    l2 = left.withColumnsRenamed({c: c + suffixes[0] for c in common})
    r2 = right.withColumnsRenamed({c: c + suffixes[1] for c in common})
    return l2.join(r2, list(on), "left")
