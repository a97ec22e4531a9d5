"""Career features with one fighter in a third of all rows, both ways.

    python tools/skew_trial.py [rows]

Prints, for the plain window and for sliced histories, the seconds and the rows
of the largest task. Both must give the same checksum.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F

from antecede.operators import heavy_keys
from antecede.plans import career
from antecede.session import build_session, written


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    max_rows = rows // 24
    spark = build_session(
        "skew",
        master="local[8]",
        spark__sql__shuffle__partitions="16",
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    bouts = spark.range(rows).selectExpr(
        "'b' || id AS bout_url",
        "if(id % 3 = 0, 'hot', 'f' || pmod(xxhash64(id), 50000)) AS fighter_url",
        "date_add(DATE '2000-01-01', CAST(id div 1000 AS int)) AS event_date",
        "element_at(array('win', 'win', 'loss', 'draw', 'no_contest'), CAST(pmod(xxhash64(id, 1), 5) + 1 AS int)) AS result",
        "pmod(xxhash64(id, 2), 3) = 0 AS is_finish",
        "CAST(pmod(xxhash64(id, 3), 1500) AS int) AS bout_duration_seconds",
        "CAST(pmod(xxhash64(id, 4), 100) AS int) AS control_time_seconds",
        "CAST(pmod(xxhash64(id, 5), 90) AS int) AS sig_strikes_landed",
        "CAST(pmod(xxhash64(id, 6), 90) AS int) AS sig_strikes_absorbed",
        "CAST(pmod(xxhash64(id, 7), 9) AS int) AS takedowns_landed",
        "CAST(pmod(xxhash64(id, 8), 9) AS int) AS takedowns_conceded",
    )
    bouts = written(bouts, "trial")
    for name, heavy in (("plain", []), ("sliced", None)):
        start = time.time()
        heavy = heavy_keys(bouts, career.ENTITY, max_rows) if heavy is None else heavy
        result = career.career_to_date(bouts, heavy=heavy, max_rows=max_rows)
        check = result.agg(
            F.count(F.lit(1)),
            F.sum("prior_bouts"),
            F.sum("prior_wins"),
            F.sum("prior_win_streak"),
            F.sum(F.col("prior_minutes_fought").cast("decimal(30,6)")),
        ).first()
        largest = rows // 3 if not heavy else max_rows
        print(f"{name:7} {time.time() - start:6.1f}s  heavy {len(heavy)}  largest task about {largest} rows  {tuple(check)}")


if __name__ == "__main__":
    main()
