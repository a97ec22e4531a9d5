"""Two-sided rows: to one row per side and back."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_pairs(
    df: DataFrame,
    common: Sequence[str],
    side_cols: Mapping[str, str],
    cross_cols: Mapping[str, str] | None = None,
    derived: Mapping[str, Callable[[str, str], Column]] | None = None,
    sides: tuple[str, str] = ("a", "b"),
    side_name: str = "corner",
) -> DataFrame:
    """Two output rows per input row, one from each side's point of view.

    ``side_cols`` maps an output name to a column pattern with ``{side}`` for
    this side; ``cross_cols`` reads the *other* side; ``derived`` builds a column
    from (my side, other side). Written as one ``inline(array(struct, struct))``,
    so the input is read once where a UNION ALL would read it twice.
    """

    def view(me: str, other: str) -> Column:
        fields = [F.lit(me).alias(side_name)]
        fields += [fn(me, other).alias(name) for name, fn in (derived or {}).items()]
        fields += [F.col(p.format(side=me)).alias(name) for name, p in side_cols.items()]
        fields += [F.col(p.format(side=other)).alias(name) for name, p in (cross_cols or {}).items()]
        return F.struct(*fields)

    first, second = sides
    return df.select(*common, F.inline(F.array(view(first, second), view(second, first))))


def pivot_sides(
    df: DataFrame,
    key: Sequence[str],
    side_col: str,
    measures: Sequence[str],
    sides: Sequence[str] = ("a", "b"),
    constant: Sequence[str] = (),
) -> DataFrame:
    """One row per key with ``<measure>_<side>`` columns.

    One exchange on the key and one sort by side: the first row of each key sees the rows of all
    sides through its window and is the one that stays. A conditional aggregation of strings would
    sort before the exchange and again after it.

    A side without a row gives NULLs, and so does a row of none of the ``sides``; of several rows
    of one side one is taken, with all its measures. Columns in ``constant`` are the same on both
    sides and are carried once, from the first row that has them.
    """
    place = F.array_position(F.lit(list(sides)), F.col(side_col))
    ordered = Window.partitionBy(*key).orderBy("_place")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row = F.struct(*measures)
    seen = {f"_{side}": F.first(F.when(F.col(side_col) == side, row), ignorenulls=True).over(whole) for side in sides}
    carried = {f"_carried_{c}": F.first(c, ignorenulls=True).over(whole) for c in constant}
    kept = df.select(*dict.fromkeys([*key, side_col, *measures, *constant]), place.alias("_place"))
    kept = kept.withColumns({"_nth": F.row_number().over(ordered), **seen, **carried}).where("_nth = 1")
    cells = [F.col(f"_{side}")[m].alias(f"{m}_{side}") for m in measures for side in sides]
    return kept.select(*key, *(F.col(f"_carried_{c}").alias(c) for c in constant), *cells)


def distinct_participants(df: DataFrame, key_cols: Sequence[str], name: str, position: str | None = None) -> DataFrame:
    """Distinct non-empty values over several key columns of the same rows.

    With ``position`` each value also carries ``first_seen``, the smallest
    position it appears at, so a caller can order by it.
    """
    carry = [F.col(position).alias("_position")] if position else []
    values = df.select(*carry, F.explode(F.array(*key_cols)).alias(name)).filter(
        F.col(name).isNotNull() & (F.col(name) != "")
    )
    if position:
        return values.groupBy(name).agg(F.min("_position").alias("first_seen"))
    return values.distinct()
