"""Strictly-prior measures: what was known about an entity before each row.

For every row, aggregates over the same entity's earlier rows (never the row
itself). The usual form is one window: one hash exchange on the entity, one
sort, frames that grow by one row at a time.

That form puts a whole entity into one task. An entity with too many rows for
that (``max_rows``) takes another way, with the same results:

1. its rows are range-partitioned on (entity, order), which cuts a long history
   into slices of about ``max_rows`` rows;
2. measures are computed inside each slice, and the result is written to the
   shared folder, so that the slice boundaries are fixed from here on;
3. each slice is reduced to one row of totals, and a window over those few rows
   gives what every slice carries in from the slices before it;
4. carried and local values are combined row by row.

Every measure below can be split this way: a prefix of a prefix. The streak is
too: wins so far minus wins so far at the last reset, and "at the last reset" is
a running maximum because the win count never falls.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from antecede.functions.numbers import safe_ratio
from antecede.operators.doubles import Within, band_parts, is_finite, joined
from antecede.operators.sizes import broadcast_if
from antecede.session import written

# Rows of one entity that one task may hold.
MAX_ROWS_PER_TASK = 5_000_000

SLICE = "_slice"

# Heavy keys the driver may hold; more of them stay a table.
MAX_LISTED_KEYS = 10_000


@dataclass(frozen=True)
class Measure:
    """One strictly-prior measure; make it with the ``prior_*`` functions. ``bands``
    are the parts a double is summed in."""

    kind: str
    value: Column
    reset: Column | None = None
    default: object = None
    within: Within | None = None
    bands: Mapping[int, Column] | None = None

    @property
    def sums(self) -> dict[str, Column]:
        """What is summed, by part."""
        if self.kind not in ("sum", "avg"):
            return {}
        return {"total": self.value} if self.bands is None else {f"band{b}": x for b, x in self.bands.items()}

    @property
    def counts(self) -> dict[str, Column]:
        """What is counted, by part."""
        part = {"count": "v", "avg": "n", "streak": "hits"}.get(self.kind)
        return {part: self.value} if part else {}

    @property
    def parts(self) -> tuple[str, ...]:
        return (*self.sums, *self.counts, *{"max": ("v",), "last": ("v",), "streak": ("mark",)}.get(self.kind, ()))


@dataclass(frozen=True)
class Heavy:
    """Entities with too many rows for one task: a table of their keys and ``n``, how many they
    are, and how many rows they have together."""

    table: DataFrame
    keys: int
    rows: int


def prior_count(condition: Column | None = None) -> Measure:
    """Earlier rows, or those meeting a condition; 0 when there are none."""
    return Measure("count", F.lit(1) if condition is None else F.when(condition, 1))


def prior_sum(value: Column, default: object = None, within: Within | None = None) -> Measure:
    """Sum over earlier rows, NULLs skipped; ``default`` when there is none.

    Doubles are added exactly, whatever their magnitude (NaN and infinite ones count as
    missing). ``within`` says that they are zero or of a magnitude between two bounds, which
    makes it cheaper; one that is not is an error."""
    return Measure("sum", value, default=default, within=within)


def prior_avg(value: Column, default: object = None, within: Within | None = None) -> Measure:
    """Mean over earlier rows, as :func:`prior_sum`."""
    return Measure("avg", value, default=default, within=within)


def prior_max(value: Column, default: object = None) -> Measure:
    """Greatest value over earlier rows."""
    return Measure("max", value, default=default)


def prior_last(value: Column, default: object = None) -> Measure:
    """The value of the row just before."""
    return Measure("last", F.struct(value.alias("v")), default=default)


def prior_streak(hit: Column, reset: Column) -> Measure:
    """Hits since the last reset. A row that is neither leaves the streak as it
    is; a row never is both."""
    return Measure("streak", F.when(hit, 1), reset=F.coalesce(reset, F.lit(False)))


def heavy_keys(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_ROWS_PER_TASK) -> Heavy:
    """Keys with more than ``max_rows`` rows.

    An exact count with map-side combine over the key columns only. Usually there are none
    or a few; more than ``MAX_LISTED_KEYS`` are left as a table in the shared folder.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_rows)
    some = counted.limit(MAX_LISTED_KEYS + 1).collect()
    if len(some) <= MAX_LISTED_KEYS:
        return Heavy(df.sparkSession.createDataFrame(some, counted.schema), len(some), sum(r["n"] for r in some))
    table = written(counted, "heavy-keys")
    size = table.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
    return Heavy(table, size["keys"], size["rows"])


def _exact(df: DataFrame, measures: Mapping[str, Measure]) -> dict[str, Measure]:
    """Sums of doubles depend on the order of addition, and so on how a history is
    cut. They are taken in whole numbers by bands instead; what is no finite number
    counts as missing."""
    values = {n: m.value for n, m in measures.items() if m.kind in ("sum", "avg")}
    if not values:
        return dict(measures)
    types = dict(df.select(*(v.alias(n) for n, v in values.items())).dtypes)
    out = dict(measures)
    for name in values:
        if types[name] in ("double", "float"):
            m = measures[name]
            counted = F.when(is_finite(m.value.cast("double")), 1) if m.kind == "avg" else m.value
            out[name] = replace(m, value=counted, bands=band_parts(m.value, m.within))
    return out


def _name(measure: str, part: str) -> str:
    return f"_{measure}__{part}"


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*order)


def _local(df: DataFrame, group: Sequence[str], order: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """The parts of every measure, over earlier rows of the same group."""
    ordered = Window.partitionBy(*group).orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    first, second = {}, {}
    for name, m in measures.items():
        first |= {_name(name, part): F.sum(x).over(before) for part, x in m.sums.items()}
        first |= {_name(name, part): F.count(x).over(before) for part, x in m.counts.items()}
        if m.kind == "max":
            first[_name(name, "v")] = F.max(m.value).over(before)
        elif m.kind == "last":
            first[_name(name, "v")] = F.lag(m.value).over(ordered)
        elif m.kind == "streak":
            second[_name(name, "mark")] = F.max(F.when(m.reset, F.col(_name(name, "hits")))).over(before)
    df = df.withColumns(first)
    return df.withColumns(second) if second else df


def _finish(df: DataFrame, measures: Mapping[str, Measure]) -> DataFrame:
    """Parts -> the measure itself; parts are dropped."""
    out = {}
    for name, m in measures.items():
        if m.kind in ("sum", "avg"):
            if m.bands is None:
                value = F.col(_name(name, "total"))
            else:
                value = joined({b: F.col(_name(name, f"band{b}")) for b in m.bands})
            if m.kind == "avg":
                value = safe_ratio(value.cast("double"), F.col(_name(name, "n")))
        elif m.kind == "streak":
            value = F.col(_name(name, "hits")) - F.coalesce(F.col(_name(name, "mark")), F.lit(0))
        elif m.kind == "last":
            value = F.col(_name(name, "v"))["v"]
        else:
            value = F.col(_name(name, "v"))
        out[name] = value if m.default is None else F.coalesce(value, F.lit(m.default))
    parts = [_name(name, part) for name, m in measures.items() for part in m.parts]
    return df.withColumns(out).drop(*parts)


def _slice_totals(
    sliced: DataFrame, entity: Sequence[str], order: Sequence[str], measures: Mapping[str, Measure]
) -> DataFrame:
    """One row per (entity, slice): what the slice adds to each measure."""
    aggs = []
    for name, m in measures.items():
        if m.kind == "streak":  # before its hits are summed under the same name
            aggs.append(F.max(F.when(m.reset, F.col(_name(name, "hits")))).alias(_name(name, "mark")))
        aggs += [F.sum(x).alias(_name(name, part)) for part, x in m.sums.items()]
        aggs += [F.count(x).alias(_name(name, part)) for part, x in m.counts.items()]
        if m.kind == "max":
            aggs.append(F.max(m.value).alias(_name(name, "v")))
        elif m.kind == "last":
            aggs.append(F.max_by(m.value, _order_struct(order)).alias(_name(name, "v")))
    return sliced.groupBy(*entity, SLICE).agg(*aggs)


def _carried(totals: DataFrame, entity: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """What each slice carries in from the entity's earlier slices."""
    ordered = Window.partitionBy(*entity).orderBy(SLICE)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    carry_of = "carry{}".format
    first, second = {}, {}
    for name, m in measures.items():
        for part in m.parts:
            column, carry = _name(name, part), carry_of(_name(name, part))
            if m.kind == "max":
                first[carry] = F.max(column).over(before)
            elif m.kind == "last":
                first[carry] = F.lag(column).over(ordered)
            elif part == "mark":
                hits = carry_of(_name(name, "hits"))
                second[carry] = F.max(F.coalesce(F.col(hits), F.lit(0)) + F.col(column)).over(before)
            else:
                first[carry] = F.sum(column).over(before)
    totals = totals.withColumns(first)
    if second:
        totals = totals.withColumns(second)
    keys = [F.col(k).alias(f"_at_{k}") for k in [*entity, SLICE]]
    return totals.select(*keys, *first, *second)


def _combine(df: DataFrame, measures: Mapping[str, Measure]) -> DataFrame:
    """Carried-in and local parts -> parts over the whole history."""
    out, carries = {}, []
    for name, m in measures.items():
        for part in m.parts:
            column = _name(name, part)
            local, carry = F.col(column), F.col("carry" + column)
            carries.append("carry" + column)
            if m.kind == "max":
                out[column] = F.greatest(carry, local)
            elif m.kind == "last":
                out[column] = F.coalesce(local, carry)
            elif part == "mark":
                carried_hits = F.coalesce(F.col("carry" + _name(name, "hits")), F.lit(0))
                out[column] = F.greatest(carry, carried_hits + local)
            else:
                out[column] = F.coalesce(local + carry, local, carry)
    return df.withColumns(out).drop(*carries, SLICE)


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys])


def _sliced(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Measure],
    slices: int,
    heavy: int,
) -> DataFrame:
    """The measures for entities too large for one task (see the module text)."""
    cut = df.repartitionByRange(slices, *entity, *order).withColumn(SLICE, F.spark_partition_id())
    local = written(_local(cut, [*entity, SLICE], order, measures), "slices")
    carried = _carried(_slice_totals(local, entity, order, measures), entity, measures)
    # At most one row per heavy entity and one per cut between slices.
    carried = broadcast_if(carried, heavy + slices)
    at = [*entity, SLICE]
    both = local.join(carried, _same_key(at), "left").drop(*(f"_at_{k}" for k in at))
    return _combine(both, measures)


def prior_measures(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Measure],
    *,
    heavy: Heavy | Sequence[Row] | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
    costly: bool = False,
) -> DataFrame:
    """``df`` with one column per measure, over the entity's strictly earlier rows.

    ``order`` must be total within an entity. ``heavy`` names the entities with
    more than ``max_rows`` rows (:func:`heavy_keys`, or rows of ``entity`` and ``n``),
    if the caller has counted them on cheaper data already; an upper bound of ``n`` will do.
    Left out, they are counted here. With heavy entities the input is read several
    times; if it is ``costly`` to compute it is written to the shared folder first.
    """
    measures = _exact(df, measures)
    if heavy is None:
        heavy = heavy_keys(df, entity, max_rows)
    elif not isinstance(heavy, Heavy):
        schema = df.select(*entity, F.lit(0).cast("bigint").alias("n")).schema
        table = df.sparkSession.createDataFrame([tuple(r[k] for k in (*entity, "n")) for r in heavy], schema)
        heavy = Heavy(table, len(heavy), sum(r["n"] for r in heavy))
    if not heavy.keys:
        return _finish(_local(df, entity, order, measures), measures)

    df = written(df, "prior-input") if costly else df
    keys = heavy.table.select(*(F.col(k).alias(f"_at_{k}") for k in entity))
    keys = broadcast_if(keys, heavy.keys)
    slices = math.ceil(heavy.rows / max_rows)

    light = _local(df.join(keys, _same_key(entity), "left_anti"), entity, order, measures)
    large = _sliced(df.join(keys, _same_key(entity), "left_semi"), entity, order, measures, slices, heavy.keys)
    return _finish(light.unionByName(large), measures)
