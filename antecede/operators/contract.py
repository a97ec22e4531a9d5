"""Enforced schemas for published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ContractError(ValueError):
    """The columns or types of a table differ from its contract."""


@dataclass(frozen=True)
class Contract:
    """Exact columns, types and order; ``NOT NULL`` in the DDL marks columns
    that must be filled."""

    table: str
    ddl: str

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def enforce_contract(df: DataFrame, contract: Contract, check_nulls: bool = True) -> DataFrame:
    """``df`` if it matches ``contract``; raises otherwise.

    Names, types and order are compared now, on the plan. The not-null rule is
    part of the returned plan: the write that publishes the table fails on the
    first missing value, with no extra pass over the data.
    """
    want = [(f.name, f.dataType.simpleString()) for f in contract.schema.fields]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if want != have:
        lines = [f"  contract {w!r}, got {h!r}" for w, h in zip(want, have) if w != h]
        lines += [f"  missing {w!r}" for w in want[len(have) :]]
        lines += [f"  unexpected {h!r}" for h in have[len(want) :]]
        raise ContractError(f"{contract.table} breaks its contract:\n" + "\n".join(lines))
    if not check_nulls:
        return df
    required = set(contract.not_null)

    def guarded(name: str, dtype: str):
        if name not in required:
            return F.col(name)
        message = F.lit(f"{contract.table}.{name} is NULL, against its contract")
        return F.coalesce(F.col(name), F.raise_error(message).cast(dtype)).alias(name)

    return df.select(*(guarded(name, dtype) for name, dtype in want))
