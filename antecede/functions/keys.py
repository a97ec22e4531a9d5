"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for a NULL part so that (NULL, 'x') and ('x') differ.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the parts joined by ``-``; never NULL."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def surrogate_key_or_null(c: Column | str) -> Column:
    """As :func:`surrogate_key`, but NULL stays NULL (optional foreign key)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), surrogate_key(c))
