"""Feature columns computed apart, put side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame


def attach_columns(base: DataFrame, keys: Sequence[str], frames: Mapping[str, DataFrame]) -> DataFrame:
    """``base`` with one column from each frame, left-joined on ``keys``; the
    mapping is column name -> frame.

    ``keys`` must identify a row of every frame, or rows multiply. All joins are
    on the same keys, so ``base`` is shuffled once for the whole chain. Measures
    over one window need no join at all: see ``prior_measures``.
    """
    columns = [frame.select(*keys, name) for name, frame in frames.items()]
    return reduce(lambda joined, frame: joined.join(frame, list(keys), "left"), columns, base)
