"""Data tests as queries: each returns the violations, empty when all is well.

Tests that group do so with map-side combine and report a violating key once,
with the number of rows behind it (``n``), so one bad key with billions of rows
stays one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from antecede.operators.prior import MAX_ROWS_PER_TASK, Heavy, prior_last, prior_measures

# Ordinals of one entity that are looked at together.
LEAKAGE_BLOCK = 1 << 16

TOLERANCE = 1e-6


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions)


def differs(a: Column, b: Column) -> Column:
    """NULL-safe inequality."""
    return ~a.eqNullSafe(b)


def apart(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """Different beyond a tolerance, or NULL on one side only."""
    return F.coalesce(F.abs(a - b) > tolerance, a.isNull() != b.isNull())


# Conditions a violating row meets. A test of one of these alone is a filter;
# many of them over one table are one pass (``RowRules``).


def is_missing(*cols: str) -> Column:
    """NULL in any of ``cols``."""
    return _any([F.col(c).isNull() for c in cols])


def is_outside(col: str, values: Sequence) -> Column:
    """Not in the list; NULL is accepted."""
    return ~F.col(col).isin(*values)


def is_out_of_range(col: str, low, high) -> Column:
    """Not in ``[low, high]``; NULL is accepted."""
    return ~F.col(col).between(low, high)


def is_false(expression: str | Column) -> Column:
    """The expression is false; NULL passes."""
    return ~(F.expr(expression) if isinstance(expression, str) else expression)


def exceeds(pairs: Sequence[tuple[str, str]]) -> Column:
    """Any first column is greater than its second."""
    return _any([F.col(x) > F.col(y) for x, y in pairs])


def is_stranger(col: str, among: Sequence[str]) -> Column:
    """Filled, but equal to none of the other columns."""
    return F.col(col).isNotNull() & ~F.col(col).isin(*(F.col(c) for c in among))


@dataclass(frozen=True)
class RowRules:
    """Named row conditions over one table, counted together in one pass."""

    table: DataFrame
    conditions: Mapping[str, Column]

    def counts(self) -> DataFrame:
        """(rule, violations)."""
        names = list(self.conditions)
        counted = self.table.agg(*(F.count_if(self.conditions[name]).alias(name) for name in names))
        cells = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in names]
        return counted.select(F.inline(F.array(*cells)))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Rows with NULL in any of ``cols``."""
    return df.filter(is_missing(*cols))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, n) of NULLs for many columns, in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in cols]
    return counts.select(F.inline(F.array(*cells)))


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return unique_combination(df.filter(F.col(col).isNotNull()), [col])


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def relationships(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys with no parent; a NULL key is ignored. Children are reduced to
    distinct keys before the join, so a hot key weighs one row in it."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values outside the list; NULL is accepted."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter(is_outside(col, values))


def accepted_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """Rows outside ``[low, high]``; NULL is accepted."""
    return df.filter(is_out_of_range(col, low, high))


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows for which the expression is false; NULL passes."""
    return df.filter(is_false(expression))


def children_per_parent(
    parent: DataFrame, key: str, child: DataFrame, child_key: str, expected: int
) -> DataFrame:
    """Parents without exactly ``expected`` children. Children are counted
    before the join."""
    counts = child.groupBy(F.col(child_key).alias(key)).agg(F.count(F.lit(1)).alias("children"))
    counted = parent.select(key).join(counts, key, "left")
    found = F.coalesce(F.col("children"), F.lit(0))
    return counted.select(key, found.alias("children")).filter(F.col("children") != expected)


def pinned_values(expected: DataFrame, keys: Sequence[str], model: DataFrame, col: str, want: str) -> DataFrame:
    """Expected rows whose value in ``model`` differs, or that it lacks. Starts
    from the expected rows, as a rule a short list written in the test."""
    return expected.join(model.select(*keys, col), list(keys), "left").filter(differs(F.col(col), F.col(want)))


def at_most(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows where any first column exceeds its second."""
    return df.filter(exceeds(pairs))


def within_parent(child: DataFrame, key: str, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Children whose value exceeds their parent's."""
    return child.join(parent.select(key, parent_col), key).filter(F.col(child_col) > F.col(parent_col))


def member_or_null(df: DataFrame, col: str, among: Sequence[str]) -> DataFrame:
    """Rows where ``col`` is filled but equals none of the other columns."""
    return df.filter(is_stranger(col, among))


def debut_is_empty(df: DataFrame, ordinal: str, zero: Sequence[str], null: Sequence[str], volume: Sequence[str]):
    """A first row, and only a first row, has an empty history: ``zero`` columns
    are 0 and ``null`` columns NULL there; ``volume`` columns are filled on every
    later row."""
    on_debut = [differs(F.col(c), F.lit(0)) for c in zero] + [F.col(c).isNotNull() for c in null]
    later = [F.col(c).isNull() for c in volume]
    first = F.col(ordinal) == 0
    return df.filter((first & _any(on_debut)) | ((F.col(ordinal) > 0) & _any(later)))


def rises_by_one(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    ordinal: str,
    heavy: Heavy | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Rows where the ordinal is not 0 on the entity's first row, or not one more
    than on the row before."""
    before = {"previous": prior_last(F.col(ordinal))}
    walked = prior_measures(df, entity, order, before, heavy=heavy, max_rows=max_rows, costly=True)
    return walked.filter(F.col(ordinal) != F.coalesce(F.col("previous") + 1, F.lit(0)))


def no_leakage(
    model: DataFrame,
    facts: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    ordinal: str,
    totals: Mapping[str, Column],
    streaks: Mapping[str, tuple[Column, Column]] | None = None,
    block_rows: int = LEAKAGE_BLOCK,
) -> DataFrame:
    """Rows of a strictly-prior model that do not follow from the row before.

    ``model`` has the entity, the order columns, the row's ``ordinal`` and one
    column per entry of ``totals`` and ``streaks``; ``facts`` has the same rows
    (joined on entity and order) with what each row itself adds. The test rests on
    induction. A first row must hold zeros; any other row must have a row with the
    ordinal below right before it, earlier in order, and hold that row's totals plus
    that row's own facts. No two rows of an entity may share an ordinal, and a row
    without its fact fails. If no row fails, every total is the sum over all strictly
    earlier rows and nothing else.

    The facts are joined one to one. Then an entity's rows go to blocks of ``block_rows``
    ordinals, the last one of a block to the next as well, and each looks at its
    neighbour there: linear in the data, one exchange, and no entity in one task.
    Joining each row to all its earlier rows would be quadratic per entity.
    """
    streaks = streaks or {}
    own = {f"own_{name}": value.cast("double") for name, value in totals.items()}
    for name, (hit, reset) in streaks.items():
        own[f"hit_{name}"], own[f"reset_{name}"] = F.coalesce(hit, F.lit(False)), F.coalesce(reset, F.lit(False))
    keys = [*entity, *order]
    names = [*totals, *streaks]
    mine = [F.col(k).alias(f"_of_{k}") for k in keys]
    facts = facts.select(*mine, *(value.alias(name) for name, value in own.items()), F.lit(True).alias("_fact"))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    rows = model.select(*keys, ordinal, *names).join(facts, same, "left").drop(*(f"_of_{k}" for k in keys))

    block = F.floor(F.col(ordinal) / block_rows)
    goes_on = F.col(ordinal) % block_rows == block_rows - 1
    blocks = F.when(goes_on, F.array(block, block + 1)).otherwise(F.array(block))
    dealt = rows.select("*", F.explode(blocks).alias("_block"))
    place = F.struct(*order)
    walk = Window.partitionBy(*entity, "_block").orderBy(ordinal, *order)
    before = F.col("_before")
    state = F.struct(F.col(ordinal).alias("_ordinal"), place.alias("_place"), *names, *own)
    paired = dealt.withColumn("_before", F.lag(state).over(walk)).where(F.col("_block").eqNullSafe(block))

    c = F.col
    # The row before has the ordinal below; a twin has the same one, and the row after it then fails.
    broken = [c("_fact").isNull(), differs(before["_ordinal"], c(ordinal) - 1), before["_place"] >= place]
    first = [c("_fact").isNull(), before["_ordinal"].isNotNull()]
    for name in totals:
        step = F.coalesce(before[name], F.lit(0)).cast("double") + F.coalesce(before[f"own_{name}"], F.lit(0.0))
        broken.append(apart(F.coalesce(c(name), F.lit(0)).cast("double"), step))
        first.append(F.coalesce(c(name), F.lit(0)) != 0)
    for name in streaks:
        step = F.when(before[f"reset_{name}"], 0).otherwise(before[name] + before[f"hit_{name}"].cast("int"))
        broken.append(differs(c(name), step))
        first.append(differs(c(name), F.lit(0)))
    is_first = c(ordinal) == 0
    failed = (is_first & _any(first)) | (~is_first & F.coalesce(_any(broken), F.lit(True))) | c(ordinal).isNull()
    return paired.filter(failed).select(*keys, ordinal, *names)


def rule_counts(rules: Mapping[str, DataFrame | RowRules]) -> DataFrame:
    """One row per rule: (rule, violations).

    A :class:`RowRules` entry gives one row for each of its conditions, whatever
    its own name. For a query of violations ``n`` is summed where it reports it,
    and rows are counted otherwise.
    """
    counted = []
    for name, rule in rules.items():
        if isinstance(rule, RowRules):
            counted.append(rule.counts())
            continue
        total = F.coalesce(F.sum("n"), F.lit(0)) if "n" in rule.columns else F.count(F.lit(1))
        counted.append(rule.agg(total.cast("bigint").alias("violations")).select(F.lit(name).alias("rule"), "*"))
    return reduce(DataFrame.unionByName, counted)
