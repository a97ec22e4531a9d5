"""The registered queries as SQL, for an engine that shares no code with ours.

Plain SELECTs over the same tables. Where a query starts from the bound raw
layer, the layer is written out as common table expressions first.
"""

from __future__ import annotations

# The references that the given pages hold; `&amp;` comes last.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", chr(160)), ("&amp;", "&"))

OWN = (
    "knockdowns",
    "sig_strikes_landed",
    "sig_strikes_attempted",
    "sig_strike_accuracy_pct",
    "total_strikes_landed",
    "total_strikes_attempted",
    "takedowns_landed",
    "takedowns_attempted",
    "takedown_accuracy_pct",
    "submission_attempts",
    "reversals",
    "control_time_seconds",
)
MAY_BE_NULL = ("sig_strike_accuracy_pct", "takedown_accuracy_pct")
CONCEDED = ("sig_strikes_absorbed", "takedowns_conceded")

BASE = """
pairs AS (
  SELECT a.event_id AS id, a.ts, a.user_id AS ua, b.user_id AS ub, a.event_type AS ta, b.event_type AS tb,
    CAST(floor(a.value) AS int) AS aa, CAST(floor(b.value) AS int) AS ab,
    CAST(1 + (a.event_id * 7) % 299 AS int) AS t,
    CASE WHEN a.event_type = 'error' AND b.event_type = 'error' THEN 'nc'
         WHEN a.event_type = b.event_type THEN 'draw' ELSE 'win' END AS outcome,
    a.value >= b.value AS a_better
  FROM events a JOIN events b ON b.event_id // 2 = a.event_id // 2 AND a.event_id < b.event_id
  WHERE a.user_id <> b.user_id),
counted AS (
  SELECT *, CAST(floor(aa * (id % 4) / 4) AS int) AS la, CAST(floor(ab * (id % 3) / 3) AS int) AS lb,
    CASE WHEN a_better THEN ta ELSE tb END AS tw,
    CASE WHEN id % 3 = 0 THEN ua % 4 ELSE 0 END AS got_a, CASE WHEN id % 7 = 0 THEN ub % 4 ELSE 0 END AS got_b
  FROM pairs),
current_bouts AS (
  SELECT id, concat('bout/', id) AS bout_url, concat('event/', CAST(ts AS date)) AS event_url,
    concat('fighter/', ua) AS fighter_a_url, concat('fighter/', ub) AS fighter_b_url,
    concat('Name ', ua) AS fighter_a_name, concat('Name ', ub) AS fighter_b_name,
    CASE WHEN outcome <> 'win' THEN outcome WHEN a_better THEN concat('Name ', ua)
         ELSE concat('Name ', ub) END AS winner_name,
    CASE WHEN id % 10 = 0 AND outcome <> 'draw' THEN NULL ELSE outcome END AS result,
    concat('Class ', ua % 5) AS weight_class,
    CASE WHEN outcome = 'nc' THEN 'Overturned' WHEN outcome = 'draw' THEN 'Decision - Split'
         WHEN tw = 'purchase' THEN 'KO/TKO' WHEN tw = 'click' THEN 'Submission'
         WHEN tw = 'view' THEN 'Decision - Unanimous' WHEN tw = 'signup' THEN 'TKO - Doctor''s Stoppage'
         ELSE 'DQ' END AS method,
    CAST(1 + id % 5 AS varchar) AS finish_round,
    concat(CAST(floor(t / 60) AS int), ':', lpad(CAST(t % 60 AS varchar), 2, '0')) AS finish_time,
    CAST(id % 3 AS varchar) AS fighter_a_knockdowns, CAST(ub % 2 AS varchar) AS fighter_b_knockdowns,
    concat(la, ' of ', aa) AS fighter_a_sig_strikes, concat(lb, ' of ', ab) AS fighter_b_sig_strikes,
    CASE WHEN aa = 0 THEN '---' ELSE concat(CAST(floor(la * 100 / aa) AS int), '%') END AS fighter_a_sig_strike_acc,
    CASE WHEN ab = 0 THEN '---' ELSE concat(CAST(floor(lb * 100 / ab) AS int), '%') END AS fighter_b_sig_strike_acc,
    concat(la + id % 5, ' of ', aa + id % 5) AS fighter_a_total_strikes,
    concat(lb + id % 6, ' of ', ab + id % 6) AS fighter_b_total_strikes,
    concat(got_a, ' of ', ua % 4) AS fighter_a_takedowns, concat(got_b, ' of ', ub % 4) AS fighter_b_takedowns,
    CASE WHEN ua % 4 = 0 THEN '---' WHEN id % 3 = 0 THEN '100%' ELSE '0%' END AS fighter_a_takedown_acc,
    CASE WHEN ub % 4 = 0 THEN '---' WHEN id % 7 = 0 THEN '100%' ELSE '0%' END AS fighter_b_takedown_acc,
    CAST(id % 4 AS varchar) AS fighter_a_sub_attempts, CAST(ub % 3 AS varchar) AS fighter_b_sub_attempts,
    CAST(ua % 2 AS varchar) AS fighter_a_reversals, CAST(ub % 2 AS varchar) AS fighter_b_reversals,
    concat('0:', lpad(CAST(t % 30 AS varchar), 2, '0')) AS fighter_a_control_time,
    CASE WHEN id % 11 = 0 THEN '--' ELSE '0:00' END AS fighter_b_control_time,
    ts AS bout_at, ts AS _ingested_at
  FROM counted),
raw_bouts AS (
  SELECT * FROM current_bouts
  UNION ALL BY NAME
  SELECT * REPLACE ('Overturned' AS method, _ingested_at - INTERVAL '1' DAY AS _ingested_at)
  FROM current_bouts WHERE id % 20 = 0),
raw_events AS (
  SELECT concat('event/', d) AS event_url, concat('Card ', d) AS event_name,
    strftime(d, '%B %d, %Y') AS event_date,
    CASE extract(day FROM d) % 3 WHEN 0 THEN 'Las Vegas, Nevada, USA' WHEN 1 THEN 'Shanghai, China'
         ELSE 'Singapore' END AS event_location
  FROM (SELECT DISTINCT CAST(ts AS date) AS d FROM events)),
raw_fighters AS (
  SELECT u, concat('fighter/', u) AS fighter_url, concat('Name ', u) AS fighter_name, 'Name' AS first_name,
    CASE WHEN u % 13 = 0 THEN '' ELSE CAST(u AS varchar) END AS last_name,
    CASE WHEN u % 9 = 0 THEN '--' ELSE concat(5 + u % 2, chr(39), ' ', u % 12, chr(34)) END AS height,
    CASE WHEN u % 8 = 0 THEN '--' ELSE concat(115 + u % 100, ' lbs.') END AS weight,
    CASE WHEN u % 7 = 0 THEN '--' ELSE concat(60 + u % 20, chr(34)) END AS reach,
    CASE u % 4 WHEN 0 THEN 'Orthodox' WHEN 1 THEN 'Southpaw' WHEN 2 THEN 'Switch' ELSE '' END AS stance,
    CASE WHEN u % 10 = 0 THEN '--' ELSE strftime(DATE '1970-01-01' + CAST(u * 37 AS int), '%b %d, %Y') END AS dob,
    concat(u % 7, '.', lpad(CAST(u % 100 AS varchar), 2, '0')) AS sig_strikes_landed_per_min,
    concat(u % 101, '%') AS sig_strike_accuracy,
    concat(u % 5, '.', lpad(CAST(u % 100 AS varchar), 2, '0')) AS sig_strikes_absorbed_per_min,
    concat(u % 97, '%') AS sig_strike_defense,
    concat(u % 4, '.', lpad(CAST(u % 100 AS varchar), 2, '0')) AS takedown_average,
    concat(u % 89, '%') AS takedown_accuracy, concat(u % 83, '%') AS takedown_defense,
    concat(u % 3, '.', lpad(CAST(u % 100 AS varchar), 2, '0')) AS submission_average
  FROM (SELECT DISTINCT user_id AS u FROM events))"""


def _null(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ('--', '---', '') THEN {c} END"


def _group(c: str, pattern: str, n: int) -> str:
    """Group ``n`` of a full match as an integer; NULL without a match."""
    return f"try_cast(regexp_extract({c}, '^{pattern}$', {n}) AS int)"


def _of(c: str, n: int) -> str:
    return _group(c, "([0-9]+) of ([0-9]+)", n)


def _percent(c: str) -> str:
    return f"CAST({_group(c, '([0-9]+)%', 1)} AS double) / 100"


def _mmss(c: str) -> str:
    minutes, seconds = (_group(c, "([0-9]+):([0-9]+)", n) for n in (1, 2))
    return f"({minutes} * 60 + {seconds})"


def _date(c: str, pattern: str) -> str:
    return f"CAST(try_strptime({c}, '{pattern}') AS date)"


def _height(c: str) -> str:
    feet, inches = (_group(c, """([0-9]+)'' ([0-9]+)\"""", n) for n in (1, 2))
    return f"({feet} * 12 + {inches})"


def _place(c: str) -> dict[str, str]:
    parts = f"string_split({c}, ',')"
    return {
        "city": f"trim({parts}[1])",
        "state": f"CASE len({parts}) WHEN 3 THEN trim({parts}[2]) END",
        "country": f"trim({parts}[-1])",
    }


def _side(s: str) -> str:
    f = f"fighter_{s}_"
    typed = {
        "knockdowns": f"try_cast({f}knockdowns AS int)",
        "sig_strikes_landed": _of(f + "sig_strikes", 1),
        "sig_strikes_attempted": _of(f + "sig_strikes", 2),
        "sig_strike_accuracy_pct": _percent(f + "sig_strike_acc"),
        "total_strikes_landed": _of(f + "total_strikes", 1),
        "total_strikes_attempted": _of(f + "total_strikes", 2),
        "takedowns_landed": _of(f + "takedowns", 1),
        "takedowns_attempted": _of(f + "takedowns", 2),
        "takedown_accuracy_pct": _percent(f + "takedown_acc"),
        "submission_attempts": f"try_cast({f}sub_attempts AS int)",
        "reversals": f"try_cast({f}reversals AS int)",
        "control_time_seconds": _mmss(f + "control_time"),
    }
    return ",\n    ".join(f"{sql} AS {f}{name}" for name, sql in typed.items())


_STAGED_PLACE = ", ".join(f"{sql} AS event_{name}" for name, sql in _place("event_location").items())

STAGED = f"""
stg_bouts AS (
  SELECT bout_url, event_url, fighter_a_url, fighter_b_url, fighter_a_name, fighter_b_name,
    CASE WHEN winner_name = fighter_a_name THEN fighter_a_url
         WHEN winner_name = fighter_b_name THEN fighter_b_url END AS winner_fighter_url,
    outcome = 'nc' AS is_no_contest, outcome = 'draw' AS is_draw, weight_class, method,
    CASE WHEN method IN ('KO/TKO', 'Submission', 'TKO - Doctor''s Stoppage') THEN true
         WHEN method LIKE 'Decision%' THEN false END AS is_finish,
    try_cast(finish_round AS int) AS finish_round, {_mmss("finish_time")} AS finish_time_seconds,
    (try_cast(finish_round AS int) - 1) * 300 + {_mmss("finish_time")} AS bout_duration_seconds,
    {_side("a")},
    {_side("b")},
    bout_at
  FROM (SELECT *, coalesce(result, CASE WHEN winner_name = 'nc' THEN 'nc' ELSE 'win' END) AS outcome
        FROM raw_bouts QUALIFY row_number() OVER (PARTITION BY bout_url ORDER BY _ingested_at DESC) = 1)),
stg_events AS (
  SELECT *, CASE WHEN event_date >= DATE '2000-09-01' THEN true ELSE false END AS is_modern_era
  FROM (SELECT event_url, event_name, {_date("event_date", "%B %d, %Y")} AS event_date, {_STAGED_PLACE},
          event_location AS event_location_raw FROM raw_events)),
stg_fighters AS (
  SELECT fighter_url, fighter_name, first_name, {_null("last_name")} AS last_name, {_height("height")} AS height_inches,
    {_group("weight", "([0-9]+) lbs[.]", 1)} AS weight_lbs, {_group("reach", '([0-9]+)"', 1)} AS reach_inches, {_null("stance")} AS stance,
    {_date("dob", "%b %d, %Y")} AS date_of_birth,
    try_cast(sig_strikes_landed_per_min AS decimal(6, 2)) AS sig_strikes_landed_per_min,
    try_cast(sig_strikes_absorbed_per_min AS decimal(6, 2)) AS sig_strikes_absorbed_per_min,
    {_percent("sig_strike_accuracy")} AS sig_strike_accuracy_pct,
    {_percent("sig_strike_defense")} AS sig_strike_defense_pct,
    try_cast(takedown_average AS decimal(6, 2)) AS takedowns_per_15_min,
    {_percent("takedown_accuracy")} AS takedown_accuracy_pct,
    {_percent("takedown_defense")} AS takedown_defense_pct,
    try_cast(submission_average AS decimal(6, 2)) AS submissions_per_15_min
  FROM raw_fighters)"""


def _by_side(columns: dict[str, tuple[str, str]]) -> str:
    """Columns that are one thing for side a and another for side b."""
    return ", ".join(f"CASE corner WHEN 'a' THEN {a} ELSE {b} END AS {name}" for name, (a, b) in columns.items())


_SIDES = _by_side(
    {
        "fighter_url": ("fighter_a_url", "fighter_b_url"),
        "opponent_fighter_url": ("fighter_b_url", "fighter_a_url"),
        "fighter_name": ("fighter_a_name", "fighter_b_name"),
        **{c: (f"fighter_a_{c}", f"fighter_b_{c}") for c in OWN},
        "sig_strikes_absorbed": ("fighter_b_sig_strikes_landed", "fighter_a_sig_strikes_landed"),
        "takedowns_conceded": ("fighter_b_takedowns_landed", "fighter_a_takedowns_landed"),
    }
)

FIGHTER_BOUTS = f"""
views AS (
  SELECT *, CASE outcome WHEN 'decided' THEN CASE WHEN mine THEN 'win' ELSE 'loss' END ELSE outcome END AS result,
    CASE outcome WHEN 'decided' THEN mine WHEN 'draw' THEN false END AS is_winner
  FROM (SELECT *, winner_fighter_url = fighter_url AS mine FROM (
    SELECT bout_url, event_url, corner, {_SIDES}, winner_fighter_url, is_finish, bout_duration_seconds, bout_at,
      weight_class, CASE WHEN is_no_contest THEN 'no_contest' WHEN is_draw THEN 'draw'
        WHEN winner_fighter_url IS NOT NULL THEN 'decided' END AS outcome
    FROM stg_bouts, (VALUES ('a'), ('b')) both_sides(corner)))),
fighter_bouts AS (
  SELECT v.* EXCLUDE (winner_fighter_url, mine, outcome), e.event_date, f.stance,
    CAST(e.event_date - f.date_of_birth AS double) / 365.25 AS age_at_bout_years
  FROM views v JOIN stg_events e USING (event_url) LEFT JOIN stg_fighters f USING (fighter_url))"""

# No window anywhere: each row is joined to all earlier rows of its fighter. The
# streak is the wins after the last loss or draw.
CAREER = """
earlier AS (
  SELECT c.bout_url, c.fighter_url, c.event_date, c.bout_at, e.bout_at AS held_at, e.result, e.is_finish,
    e.bout_duration_seconds AS seconds, e.sig_strikes_landed - e.sig_strikes_absorbed AS strikes,
    e.takedowns_landed - e.takedowns_conceded AS takedowns, e.control_time_seconds AS control
  FROM fighter_bouts c LEFT JOIN fighter_bouts e ON e.fighter_url = c.fighter_url AND e.bout_at < c.bout_at),
history AS (
  SELECT bout_url, fighter_url, event_date, bout_at, count(held_at) AS prior_bouts,
    count(*) FILTER (result = 'win') AS prior_wins, count(*) FILTER (result = 'loss') AS prior_losses,
    count(*) FILTER (result = 'draw') AS prior_draws,
    count(*) FILTER (result = 'win' AND is_finish) AS finishes, max(held_at) FILTER (result IN ('loss', 'draw')) AS reset_at,
    CAST(coalesce(sum(seconds), 0) AS double) AS seconds, CAST(sum(strikes) AS double) AS strikes,
    CAST(sum(takedowns) AS double) AS takedowns, CAST(sum(control) AS double) AS control
  FROM earlier GROUP BY ALL),
streaks AS (
  SELECT h.bout_url, h.fighter_url, count(e.held_at) AS prior_win_streak
  FROM history h LEFT JOIN earlier e ON e.bout_url = h.bout_url AND e.fighter_url = h.fighter_url
    AND e.result = 'win' AND (h.reset_at IS NULL OR e.held_at > h.reset_at)
  GROUP BY ALL),
career AS (
  SELECT bout_url, fighter_url, event_date, bout_at, prior_bouts, prior_wins, prior_losses, prior_draws,
    prior_win_streak, prior_wins / nullif(CAST(prior_wins + prior_losses + prior_draws AS double), 0) AS prior_win_rate,
    finishes / nullif(CAST(prior_wins AS double), 0) AS prior_finish_rate, minutes AS prior_minutes_fought,
    minutes / nullif(prior_bouts, 0) AS prior_avg_fight_minutes,
    strikes / nullif(minutes, 0) AS prior_sig_strike_diff_per_min,
    takedowns / nullif(seconds / CAST(900 AS double), 0) AS prior_takedown_diff_per_15,
    control / nullif(seconds, 0) AS prior_control_share
  FROM (SELECT *, seconds / CAST(60 AS double) AS minutes FROM history) JOIN streaks USING (bout_url, fighter_url))"""


def _features(legacy: bool) -> str:
    breaks = "result IS DISTINCT FROM 'win'" if legacy else "result IN ('loss', 'draw')"
    rate = (
        "coalesce(CAST(finish_wins AS double) / nullif(num_bouts, 0), 0)"
        if legacy
        else "CAST(finish_wins AS double) / nullif(wins, 0)"
    )
    return f"""
shares AS (
  SELECT *, (control_time_seconds / CAST(60 AS double)) / nullif(bout_duration_seconds / CAST(60 AS double), 0)
    AS control_share FROM fighter_bouts),
feature_sums AS (
  SELECT *, count(*) OVER prior AS num_bouts,
    avg(CASE WHEN result = 'win' THEN 1 ELSE 0 END) OVER prior AS win_percentage,
    CAST(sum(bout_duration_seconds) OVER prior AS double) AS seconds,
    avg(bout_duration_seconds / CAST(60 AS double)) OVER prior AS avg_fight_minutes,
    count(CASE WHEN result = 'win' THEN 1 END) OVER prior AS wins,
    count(CASE WHEN result = 'win' AND is_finish THEN 1 END) OVER prior AS finish_wins,
    CAST(sum(sig_strikes_landed) OVER prior AS double) / nullif(sum(sig_strikes_absorbed) OVER prior, 0) AS strike_ratio,
    CAST(sum(takedowns_landed) OVER prior AS double) / nullif(sum(takedowns_conceded) OVER prior, 0) AS takedown_ratio,
    avg(control_share) OVER prior AS avg_control_share,
    max(CASE WHEN {breaks} THEN bout_at END) OVER prior AS reset_at
  FROM shares
  WINDOW prior AS (PARTITION BY fighter_url ORDER BY bout_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
features AS (
  SELECT *, {rate} AS finish_rate, age_at_bout_years AS age,
    (SELECT count(*) FROM shares e WHERE e.fighter_url = s.fighter_url AND e.result = 'win' AND e.bout_at < s.bout_at
       AND (s.reset_at IS NULL OR e.bout_at > s.reset_at)) AS win_streak
  FROM feature_sums s)"""


MATRIX = (
    "fighter_url",
    "fighter_name",
    "avg_control_share",
    "num_bouts",
    "win_percentage",
    "avg_fight_minutes",
    "age",
    "finish_rate",
    "strike_ratio",
    "takedown_ratio",
    "weight_class",
    "stance",
    "win_streak",
)
ROUNDED = ("avg_control_share", "avg_fight_minutes", "control_share")


def _cell(m: str, s: str) -> str:
    value = f"max(CASE WHEN corner = '{s}' THEN {m} END)"
    return f"{f'round({value}, 9)' if m in ROUNDED else value} AS {m}_{s}"


def _matrix(legacy: bool, measures: tuple[str, ...]) -> str:
    cells = ", ".join(_cell(m, s) for m in measures for s in "ab")
    label = """(SELECT CASE WHEN s.is_draw THEN 'draw' WHEN s.is_no_contest THEN 'nc'
        WHEN s.winner_fighter_url = s.fighter_a_url THEN s.fighter_a_name
        WHEN s.winner_fighter_url = s.fighter_b_url THEN s.fighter_b_name END"""
    return _with(
        FIGHTER_BOUTS,
        _features(legacy),
        body=f"""SELECT w.*, l.winner FROM (SELECT bout_url, max(event_url) AS event_url, {cells}
          FROM features GROUP BY bout_url) w
        LEFT JOIN {label} AS winner, s.bout_url FROM stg_bouts s) l ON l.bout_url = w.bout_url""",
    )


def _with(*more: str, body: str, staged: bool = True) -> str:
    parts = [BASE, *([STAGED] if staged else []), *more]
    return "WITH " + ",".join(parts) + "\n" + body


def _raw(body: str) -> str:
    return _with(body=body, staged=False)


def _per_value(source: str, rendered: str, **parsed: str) -> str:
    columns = ", ".join(f"{sql} AS {name}" for name, sql in parsed.items())
    return f"SELECT rendered, n, {columns} FROM (SELECT {rendered} AS rendered, count(*) AS n FROM {source} GROUP BY 1)"


def _unescape(c: str) -> str:
    for reference, character in REFERENCES:
        quoted = character.replace("'", "''")
        c = f"replace({c}, '{reference}', '{quoted}')"
    return c


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _joined_text(c: str) -> str:
    cut = f"regexp_replace({c}, '\\s*<[^>]*>\\s*', '', 'g')"
    return _strip(_unescape(cut))


def _text(c: str) -> str:
    return _strip(_unescape(f"regexp_replace({c}, '<[^>]*>', '', 'g')"))


def _sk(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS varchar), '_dbt_utils_surrogate_key_null_')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def _rules(rules: dict[str, str]) -> str:
    """(rule, violations) from one violations query per rule."""
    return "\nUNION ALL\n".join(
        f"SELECT '{rule}' AS rule, CAST((SELECT {agg} FROM ({sql})) AS bigint) AS violations"
        for rule, (agg, sql) in ((r, s if isinstance(s, tuple) else ("count(*)", s)) for r, s in rules.items())
    )


def _summed(sql: str) -> tuple[str, str]:
    return "coalesce(sum(n), 0)", sql


def _unique(t: str, *cols: str):
    keys = ", ".join(cols)
    kept = f"WHERE {cols[0]} IS NOT NULL" if len(cols) == 1 else ""
    return _summed(f"SELECT {keys}, count(*) AS n FROM {t} {kept} GROUP BY {keys} HAVING count(*) > 1")


def _nulls(t: str, *cols: str) -> str:
    return f"SELECT 1 FROM {t} WHERE " + " OR ".join(f"{c} IS NULL" for c in cols)


def _orphans(t: str, c: str, parent: str, pc: str) -> str:
    return f"SELECT 1 FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {parent} WHERE {pc} IS NOT NULL)"


def _outside(t: str, c: str, values: list) -> str:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"SELECT 1 FROM {t} WHERE {c} NOT IN ({listed})"


def _not_between(t: str, c: str) -> str:
    return f"SELECT 1 FROM {t} WHERE NOT ({c} BETWEEN 0 AND 1)"


_FCT_BOUT = f"""SELECT {_sk("b.bout_url")} AS bout_sk, b.bout_url, {_sk("b.event_url")} AS event_sk,
    {_sk("fighter_a_url")} AS fighter_a_sk, {_sk("fighter_b_url")} AS fighter_b_sk,
    CASE WHEN winner_fighter_url IS NOT NULL THEN {_sk("winner_fighter_url")} END AS winner_fighter_sk,
    e.event_date, weight_class, method, is_finish, is_no_contest, is_draw, finish_round, finish_time_seconds,
    bout_duration_seconds
  FROM stg_bouts b JOIN stg_events e ON b.event_url = e.event_url"""

_DIM_EVENT = f"""SELECT {_sk("event_url")} AS event_sk, event_url, event_name, event_date, event_city, event_state,
  event_country, is_modern_era FROM stg_events"""
_DIM_FIGHTER = f"SELECT {_sk('fighter_url')} AS fighter_sk, * FROM stg_fighters"
_FCT_FIGHTER_BOUT = (
    f"SELECT {_sk('bout_url', 'fighter_url')} AS fighter_bout_sk, {_sk('bout_url')} AS bout_sk, "
    f"{_sk('event_url')} AS event_sk, {_sk('fighter_url')} AS fighter_sk, "
    f"{_sk('opponent_fighter_url')} AS opponent_fighter_sk, "
    + ", ".join(["corner", "is_winner", "result", "age_at_bout_years", *OWN, *CONCEDED])
    + " FROM fighter_bouts"
)

MARTS = f"""
dim_event AS ({_DIM_EVENT}), dim_fighter AS ({_DIM_FIGHTER}), fct_bout AS ({_FCT_BOUT}),
fct_fighter_bout AS ({_FCT_FIGHTER_BOUT})"""

_SOURCE_RULES = {
    "raw_events_not_null": _nulls("raw_events", "event_url", "event_date"),
    "raw_bouts_not_null": _nulls("raw_bouts", "bout_url", "event_url", "fighter_a_url", "fighter_b_url"),
    "raw_bouts_result": _outside("raw_bouts", "result", ["win", "draw", "nc"]),
    "raw_fighters_not_null": _nulls("raw_fighters", "fighter_url"),
}
_STAGING_RULES = {
    "stg_events_unique": _unique("stg_events", "event_url"),
    "stg_events_not_null": _nulls(
        "stg_events", "event_url", "event_date", "event_city", "event_country", "is_modern_era"
    ),
    "stg_bouts_unique": _unique("stg_bouts", "bout_url"),
    "stg_bouts_not_null": _nulls(
        "stg_bouts",
        "bout_url",
        "event_url",
        "fighter_a_url",
        "fighter_b_url",
        "is_no_contest",
        "is_draw",
        "finish_round",
        "finish_time_seconds",
        "bout_duration_seconds",
        "method",
    ),
    "stg_bouts_event": _orphans("stg_bouts", "event_url", "stg_events", "event_url"),
    "stg_bouts_fighter_a": _orphans("stg_bouts", "fighter_a_url", "stg_fighters", "fighter_url"),
    "stg_bouts_fighter_b": _orphans("stg_bouts", "fighter_b_url", "stg_fighters", "fighter_url"),
    "stg_bouts_round": _outside("stg_bouts", "finish_round", [1, 2, 3, 4, 5]),
    "stg_fighters_unique": _unique("stg_fighters", "fighter_url"),
    "stg_fighters_not_null": _nulls("stg_fighters", "fighter_url", "fighter_name"),
    "stg_fighters_stance": _outside(
        "stg_fighters", "stance", ["Orthodox", "Southpaw", "Switch", "Open Stance", "Sideways"]
    ),
}
_CAREER_RULES = {
    "career_grain": _unique("career", "bout_url", "fighter_url"),
    "career_order": _unique("career", "fighter_url", "bout_at"),
    "career_not_null": _nulls(
        "career",
        "bout_url",
        "fighter_url",
        "event_date",
        "prior_bouts",
        "prior_wins",
        "prior_losses",
        "prior_draws",
        "prior_win_streak",
        "prior_minutes_fought",
    ),
    "career_win_rate_range": _not_between("career", "prior_win_rate"),
    "career_finish_rate_range": _not_between("career", "prior_finish_rate"),
    "career_control_share_range": _not_between("career", "prior_control_share"),
}
_LANDED = """SELECT 1 FROM fct_fighter_bout WHERE sig_strikes_landed > sig_strikes_attempted
  OR takedowns_landed > takedowns_attempted OR total_strikes_landed > total_strikes_attempted"""
_CONTROL = """SELECT 1 FROM fct_fighter_bout f JOIN fct_bout b ON f.bout_sk = b.bout_sk
  WHERE f.control_time_seconds > b.bout_duration_seconds"""
_MART_RULES = {
    "dim_event_sk": _unique("dim_event", "event_sk"),
    "dim_event_url": _unique("dim_event", "event_url"),
    "dim_fighter_sk": _unique("dim_fighter", "fighter_sk"),
    "dim_fighter_url": _unique("dim_fighter", "fighter_url"),
    "fct_bout_sk": _unique("fct_bout", "bout_sk"),
    "fct_bout_url": _unique("fct_bout", "bout_url"),
    "fct_bout_winner_filled": "SELECT 1 FROM fct_bout WHERE NOT ((winner_fighter_sk IS NULL) = (is_no_contest OR is_draw))",
    "fct_bout_duration": "SELECT 1 FROM fct_bout WHERE NOT (bout_duration_seconds > 0)",
    "fct_bout_event": _orphans("fct_bout", "event_sk", "dim_event", "event_sk"),
    "fct_fighter_bout_sk": _unique("fct_fighter_bout", "fighter_bout_sk"),
    "fct_fighter_bout_grain": _unique("fct_fighter_bout", "bout_sk", "corner"),
    "fct_fighter_bout_bout": _orphans("fct_fighter_bout", "bout_sk", "fct_bout", "bout_sk"),
    "fct_fighter_bout_event": _orphans("fct_fighter_bout", "event_sk", "dim_event", "event_sk"),
    "fct_fighter_bout_corner": _outside("fct_fighter_bout", "corner", ["a", "b"]),
    "fct_fighter_bout_result": _outside("fct_fighter_bout", "result", ["win", "loss", "draw", "no_contest"]),
    "two_rows_per_bout": """SELECT b.bout_sk FROM fct_bout b LEFT JOIN fct_fighter_bout f ON f.bout_sk = b.bout_sk
        GROUP BY b.bout_sk HAVING count(f.bout_sk) <> 2""",
    "winner_is_a_participant": """SELECT 1 FROM fct_bout WHERE winner_fighter_sk IS NOT NULL
        AND winner_fighter_sk NOT IN (fighter_a_sk, fighter_b_sk)""",
    "landed_not_above_attempted": _LANDED,
    "control_within_duration": _CONTROL,
    **{
        f"fct_bout_{c}": _orphans("fct_bout", c, "dim_fighter", "fighter_sk")
        for c in ("fighter_a_sk", "fighter_b_sk", "winner_fighter_sk")
    },
    **{
        f"fct_fighter_bout_{c}": _orphans("fct_fighter_bout", c, "dim_fighter", "fighter_sk")
        for c in ("fighter_sk", "opponent_fighter_sk")
    },
}

# ``career`` is the self-join; here the same totals by window, row against row.
_LEAK_QUERY = """SELECT 'no_leakage' AS rule, count(*) AS rows_checked,
    count(*) FILTER (c.prior_bouts <> w.n OR c.prior_wins <> w.wins OR c.prior_losses <> w.losses
      OR c.prior_draws <> w.draws OR abs(c.prior_minutes_fought * 60 - w.seconds) > 0.0001) AS violations
  FROM career c LEFT JOIN (
    SELECT bout_url, fighter_url, row_number() OVER upto - 1 AS n,
      sum(CAST(result = 'win' AS int)) OVER upto - CAST(result = 'win' AS int) AS wins,
      sum(CAST(result = 'loss' AS int)) OVER upto - CAST(result = 'loss' AS int) AS losses,
      sum(CAST(result = 'draw' AS int)) OVER upto - CAST(result = 'draw' AS int) AS draws,
      sum(bout_duration_seconds) OVER upto - bout_duration_seconds AS seconds
    FROM fighter_bouts WINDOW upto AS (PARTITION BY fighter_url ORDER BY bout_at)) w USING (bout_url, fighter_url)"""

_VOLUME = (
    "prior_avg_fight_minutes",
    "prior_sig_strike_diff_per_min",
    "prior_takedown_diff_per_15",
    "prior_control_share",
)
_NOT_ZERO = " OR ".join(
    f"({c}) IS DISTINCT FROM 0"
    for c in ("prior_wins + prior_losses + prior_draws", "prior_win_streak", "prior_minutes_fought")
)
_FILLED = " OR ".join(f"{c} IS NOT NULL" for c in ("prior_win_rate", "prior_finish_rate", *_VOLUME))
_GAPS = " OR ".join(f"{c} IS NULL" for c in _VOLUME)
_DEBUT_QUERY = f"""SELECT 'debut_is_empty' AS rule, count(*) AS rows_checked,
  count(*) FILTER (CASE WHEN prior_bouts = 0 THEN {_NOT_ZERO} OR {_FILLED} ELSE {_GAPS} END) AS violations FROM career"""

_RISE_QUERY = """SELECT 'rises_by_one' AS rule, count(*) AS rows_checked,
  count(*) FILTER (prior_bouts <> place - 1) AS violations
  FROM (SELECT *, row_number() OVER (PARTITION BY fighter_url ORDER BY bout_at) AS place FROM career)"""


def _streak(resets: str) -> str:
    """Wins after the last row that resets the streak, by self-join."""
    return _with(
        FIGHTER_BOUTS,
        f"""
earlier AS (
  SELECT c.bout_url, c.fighter_url, c.result AS own, e.bout_at AS held_at, e.result
  FROM fighter_bouts c LEFT JOIN fighter_bouts e ON e.fighter_url = c.fighter_url AND e.bout_at < c.bout_at),
resets AS (
  SELECT bout_url, fighter_url, own, max(held_at) FILTER ({resets}) AS reset_at FROM earlier GROUP BY ALL)""",
        body="""SELECT r.bout_url, r.fighter_url, r.own AS result, count(e.held_at) AS streak
  FROM resets r LEFT JOIN earlier e ON e.bout_url = r.bout_url AND e.fighter_url = r.fighter_url
    AND e.result = 'win' AND (r.reset_at IS NULL OR e.held_at > r.reset_at)
  GROUP BY ALL""",
    )


_PLACE_RENDERED = """CASE c_custkey % 4 WHEN 0 THEN c_mktsegment || ', ' || n_name || ', ' || r_name
  WHEN 1 THEN n_name || ', ' || r_name WHEN 2 THEN r_name
  ELSE c_mktsegment || ', ' || n_name || ', ' || n_name || ', ' || r_name END"""
_PLACED = """customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_HEIGHT_RENDERED = """CASE WHEN p_size % 9 = 0 THEN '--' WHEN p_size % 9 = 1 THEN concat(4 + p_size % 4, chr(39))
  ELSE concat(4 + p_size % 4, chr(39), ' ', p_partkey % 12, chr(34)) END"""


def _elements(tag: str) -> str:
    found = f"regexp_extract_all(html, '(?s)<{tag}\\b[^>]*>(.*?)</{tag}>', 1)"
    return f"""SELECT url, position, {_joined_text("e")} AS text FROM (
      SELECT url, unnest(found) AS e, CAST(unnest(range(len(found))) AS int) AS position
      FROM (SELECT url, {found} AS found FROM pages))"""


_LINKS = f"""SELECT url, position, {_unescape("regexp_extract(a, '<[^>]*\\shref=" + chr(34) + "([^" + chr(34) + "]*)" + chr(34) + "', 1)")} AS href,
  {_text("a")} AS text FROM (
    SELECT url, unnest(found) AS a, CAST(unnest(range(len(found))) AS int) AS position
    FROM (SELECT url, regexp_extract_all(html, '(?s)<li\\b[^>]*>\\s*(<a\\s[^>]*>.*?</a>)', 1) AS found FROM pages))"""

_BOX_COLUMNS = ", ".join(
    f"fighter_{side}_{name}"
    for name in (
        "name",
        "knockdowns",
        "sig_strikes",
        "sig_strike_acc",
        "total_strikes",
        "takedowns",
        "takedown_acc",
        "sub_attempts",
        "reversals",
        "control_time",
    )
    for side in "ab"
)

_SQL_CAREER_COLUMNS = """bout_url, fighter_url, event_date, prior_bouts, prior_wins, prior_losses, prior_draws,
  prior_win_streak, prior_win_rate, prior_finish_rate, prior_minutes_fought, prior_avg_fight_minutes,
  prior_sig_strike_diff_per_min, prior_takedown_diff_per_15, prior_control_share"""

_INGESTED = """SELECT CAST(event_id AS varchar) AS event_id, CAST(user_id AS varchar) AS user_id, event_type,
  CAST(value AS varchar) AS value, CAST(ts AS date) AS dt FROM events"""

_CAREER_SQL = _with(FIGHTER_BOUTS, CAREER, body=f"SELECT {_SQL_CAREER_COLUMNS} FROM career")

ORACLES: dict[str, str] = {
    # column functions
    "parse_of_pairs": _per_value(
        "lineitem",
        "CASE WHEN l_linenumber = 7 THEN '---' ELSE concat(CAST(l_quantity AS int), ' of ', CAST(l_quantity AS int) + l_linenumber) END",
        landed=_of("rendered", 1),
        attempted=_of("rendered", 2),
    ),
    "parse_percentage": _per_value(
        "lineitem",
        "CASE WHEN l_tax = 0 THEN '---' ELSE concat(CAST(round(l_discount * 100) * 10 + l_linenumber AS int), '%') END",
        share=_percent("rendered"),
    ),
    "parse_mmss": _per_value(
        "lineitem",
        "CASE WHEN l_linenumber = 7 THEN '--' ELSE concat(l_partkey % 90, ':', lpad(CAST(l_suppkey % 60 AS varchar), 2, '0')) END",
        seconds=_mmss("rendered"),
    ),
    "parse_site_date_long": _per_value(
        "orders",
        "CASE WHEN o_orderstatus = 'P' THEN '--' ELSE strftime(o_orderdate, '%B %d, %Y') END",
        parsed=_date("rendered", "%B %d, %Y"),
    ),
    "parse_site_date_short": _per_value(
        "orders",
        "CASE WHEN o_orderstatus = 'P' THEN '--' ELSE strftime(o_orderdate, '%b %d, %Y') END",
        parsed=_date("rendered", "%b %d, %Y"),
    ),
    "parse_height": _per_value("part", _HEIGHT_RENDERED, inches=_height("rendered")),
    "parse_unit_number": _per_value(
        "customer",
        "CASE WHEN c_nationkey = 0 THEN '--' ELSE concat(CAST(floor(abs(c_acctbal)) AS int), ' lbs.') END",
        number=_group("rendered", "([0-9]+) lbs[.]", 1),
    ),
    "parse_inches": _per_value(
        "part",
        "CASE WHEN p_size % 9 = 0 THEN '--' ELSE concat(p_size, chr(34)) END",
        inches=_group("rendered", '([0-9]+)"', 1),
    ),
    "nullify_sentinels": _per_value(
        "orders",
        "CASE o_orderstatus WHEN 'P' THEN '--' WHEN 'F' THEN CASE WHEN o_custkey % 2 = 0 THEN '---' ELSE '' END ELSE o_orderpriority END",
        kept=_null("rendered"),
    ),
    "split_location": _per_value(_PLACED, _PLACE_RENDERED, **_place("rendered")),
    "split_full_name": _per_value(
        "part",
        "CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_name ELSE p_name || ' ' || p_type END",
        first="split_part(rendered, ' ', 1)",
        last="CASE WHEN strpos(rendered, ' ') = 0 THEN '' ELSE substr(rendered, strpos(rendered, ' ') + 1) END",
    ),
    "canonical_link": """SELECT page_id, link, link AS link_again FROM (SELECT page_id,
        CASE WHEN url LIKE 'http://%' AND url NOT LIKE 'http://www.%' THEN 'http://www.' || substr(url, 8) ELSE url END
        AS link FROM pages)""",
    "surrogate_keys": f"""SELECT o_orderkey, {_sk("o_orderkey")} AS order_sk,
        {_sk("o_orderkey", "optional", "o_custkey")} AS composite_sk,
        CASE WHEN optional IS NOT NULL THEN {_sk("optional")} END AS optional_sk
      FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS optional FROM orders)""",
    # generic operators
    "latest_version": """SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "prior_averages": """SELECT o_orderkey, o_custkey, count(*) OVER prior AS prior_orders,
        count(CASE WHEN o_orderstatus = 'O' THEN 1 END) OVER prior AS prior_open,
        CAST(sum(cents) OVER prior AS bigint) AS prior_cents, avg(cents) OVER prior AS prior_avg_cents,
        max(cents) OVER prior AS prior_max_cents,
        coalesce(lag(cents) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 0) AS previous_cents
      FROM (SELECT *, CAST(round(o_totalprice * 100) AS bigint) AS cents FROM orders)
      WINDOW prior AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "select_window_topk": """SELECT o_orderkey, CAST(o_orderdate AS date) AS ordered_on, o_totalprice FROM orders
        WHERE CAST(o_orderdate AS date) BETWEEN DATE '1995-01-01' AND DATE '1997-06-30'
        ORDER BY ordered_on DESC, o_orderkey LIMIT 100""",
    "select_events": _with(
        body="""SELECT event_url, event_name, event_date FROM stg_events
          WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""
    ),
    "paged_list": "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 25 OFFSET 50",
    "point_lookup_customer": "SELECT * FROM customer WHERE c_custkey = 77",
    "high_watermark_increment": """SELECT event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
        FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20') GROUP BY event_type""",
    "resume_keys": """SELECT o_orderkey, o_custkey FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')""",
    "freshness_of_events": """SELECT CAST(floor(age / 86400) AS bigint) AS age_days,
        CASE WHEN age > 30 * 86400 THEN 'error' WHEN age > 8 * 86400 THEN 'warn' ELSE 'pass' END AS status
      FROM (SELECT epoch(TIMESTAMP '2024-02-10') - epoch(max(ts)) AS age FROM events)""",
    # the pipeline
    "stage_bouts": _with(body="SELECT * EXCLUDE (bout_at) FROM stg_bouts"),
    "stage_events": _with(body="SELECT * FROM stg_events"),
    "stage_fighters": _with(body="SELECT * FROM stg_fighters"),
    "unpivot_pairs": _with(FIGHTER_BOUTS, body="SELECT * EXCLUDE (bout_at) FROM fighter_bouts"),
    "distinct_fighters": _raw("""SELECT fighter_url, min(id) AS first_seen FROM (
        SELECT fighter_a_url AS fighter_url, id FROM raw_bouts UNION ALL SELECT fighter_b_url, id FROM raw_bouts)
        WHERE fighter_url <> '' GROUP BY fighter_url"""),
    "career_to_date": _CAREER_SQL,
    "career_to_date_sliced": _CAREER_SQL,
    "win_streak": _streak("result IN ('loss', 'draw')"),
    "win_streak_legacy": _streak("result IS DISTINCT FROM 'win'"),
    "prior_ratio": _with(
        FIGHTER_BOUTS, _features(False), body="SELECT bout_url, fighter_url, strike_ratio, takedown_ratio FROM features"
    ),
    "attached_features": _with(
        FIGHTER_BOUTS,
        CAREER,
        body="""SELECT c.bout_url, c.fighter_url, c.prior_bouts AS num_bouts, c.prior_win_streak AS win_streak,
          (SELECT CAST(sum(e.sig_strikes_landed) AS bigint) FROM fighter_bouts e
           WHERE e.fighter_url = c.fighter_url AND e.bout_at < c.bout_at) AS strikes FROM career c""",
    ),
    "prior_rates": _with(
        FIGHTER_BOUTS,
        _features(True),
        body="""SELECT bout_url, fighter_url, num_bouts, win_percentage, round(avg_fight_minutes, 9)
          AS avg_fight_minutes, finish_rate FROM features""",
    ),
    "control_share": _with(
        FIGHTER_BOUTS,
        _features(False),
        body="""SELECT bout_url, fighter_url, round(control_share, 9) AS control_share,
          round(avg_control_share, 9) AS avg_control_share FROM features""",
    ),
    "feature_matrix": _matrix(False, MATRIX),
    "feature_matrix_legacy": _matrix(True, (*MATRIX, "control_share")),
    "dim_event": _with(body=_DIM_EVENT),
    "dim_fighter": _with(body=_DIM_FIGHTER),
    "fct_bout": _with(body=_FCT_BOUT),
    "fct_fighter_bout": _with(FIGHTER_BOUTS, body=_FCT_FIGHTER_BOUT),
    "fighter_list": _with(
        body="""SELECT fighter_url, first_name, last_name, date_of_birth FROM stg_fighters
          ORDER BY fighter_url LIMIT 25 OFFSET 25"""
    ),
    "fighter_lookup": _with(body="SELECT * FROM stg_fighters WHERE fighter_url = 'fighter/7'"),
    # data tests
    "dq_not_null": _with(
        FIGHTER_BOUTS,
        MARTS,
        body="\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n FROM fct_fighter_bout"
            for c in (
                "fighter_bout_sk",
                "bout_sk",
                "event_sk",
                "fighter_sk",
                "opponent_fighter_sk",
                "corner",
                "result",
                *(c for c in OWN if c not in MAY_BE_NULL),
                *CONCEDED,
            )
        ),
    ),
    "dq_unique": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1",
    "dq_relationships": """SELECT doc_id, count(*) AS n FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
    "dq_accepted_values": """SELECT o_orderpriority, count(*) AS n FROM orders
        WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY o_orderpriority""",
    "dq_unique_combination": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_accepted_range": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE NOT (l_quantity BETWEEN 2 AND 49)""",
    "dq_expression": """SELECT l_orderkey, l_linenumber, l_tax, l_discount FROM lineitem
        WHERE NOT (l_tax > 0.01 OR l_discount < 0.09)""",
    "dq_sources": _raw(_rules(_SOURCE_RULES)),
    "dq_staging": _with(body=_rules(_STAGING_RULES)),
    "dq_career": _with(FIGHTER_BOUTS, CAREER, body=_rules(_CAREER_RULES)),
    "dq_marts": _with(FIGHTER_BOUTS, MARTS, body=_rules(_MART_RULES)),
    "dq_pins": _with(
        FIGHTER_BOUTS,
        MARTS,
        body="""SELECT e.bout_url, true AS want, b.is_draw
          FROM (SELECT concat('bout/', 2 * n) AS bout_url FROM range(10) r(n)) e
          LEFT JOIN fct_bout b ON e.bout_url = b.bout_url WHERE b.is_draw IS DISTINCT FROM true""",
    ),
    "dq_leakage": _with(FIGHTER_BOUTS, CAREER, body=_LEAK_QUERY),
    "dq_leakage_found": _with(
        FIGHTER_BOUTS,
        """
leaky AS (
  SELECT bout_url, fighter_url, bout_at, result = 'win' AS won, bout_duration_seconds AS own,
    row_number() OVER upto - 1 AS n, count(CASE WHEN result = 'win' THEN 1 END) OVER upto AS wins,
    CAST(sum(bout_duration_seconds) OVER upto AS bigint) AS seconds
  FROM fighter_bouts WINDOW upto AS (PARTITION BY fighter_url ORDER BY bout_at
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
walked AS (
  SELECT *, coalesce(lag(wins + CASE WHEN won THEN 1 ELSE 0 END) OVER w, 0) AS wins_due,
    coalesce(lag(seconds + own) OVER w, 0) AS seconds_due
  FROM leaky WINDOW w AS (PARTITION BY fighter_url ORDER BY bout_at))""",
        body="""SELECT bout_url, fighter_url, n, wins, seconds FROM walked
          WHERE wins <> wins_due OR seconds <> seconds_due""",
    ),
    "dq_streak_pins": _with(
        FIGHTER_BOUTS,
        CAREER,
        body="""SELECT f.bout_url, f.fighter_url, 1 AS expected_streak, c.prior_win_streak
          FROM (SELECT * FROM fighter_bouts QUALIFY row_number() OVER (PARTITION BY fighter_url ORDER BY bout_at) = 1) f
          JOIN career c ON c.bout_url = f.bout_url AND c.fighter_url = f.fighter_url WHERE f.corner = 'b'""",
    ),
    "dq_debut": _with(FIGHTER_BOUTS, CAREER, body=_DEBUT_QUERY),
    "dq_rise_by_one": _with(FIGHTER_BOUTS, CAREER, body=_RISE_QUERY),
    # landing and loading
    "ingest_batch": _INGESTED,
    "ingest_stream": _INGESTED,
    "ingest_mixed": _INGESTED,
    "ingest_new_checkpoint": _INGESTED,
    "ingest_mixed_precision": """SELECT CAST(event_id AS varchar) AS event_id, epoch_us(ts) AS us,
        CAST(ts AS date) AS dt FROM events""",
    **dict.fromkeys(("ingest_bad_file", "ingest_stream_mixed"), """SELECT CAST(event_id AS varchar) AS event_id,
        epoch_us(ts) AS us, CASE WHEN event_id % 3 = 2 THEN event_type END AS note, CAST(ts AS date) AS dt,
        true AS set_aside FROM events"""),
    "empty_from_sample": """SELECT o_orderkey, o_orderstatus, o_totalprice, 0 AS rows_before FROM orders
        WHERE o_orderstatus = 'P'""",
    "layers_by_name": _with(body="SELECT md5(event_url) AS event_sk, event_url, event_name, event_date FROM stg_events"),
    "seed_typed": """SELECT CASE WHEN bad THEN 'set aside' ELSE note END AS note, count(*) AS n,
          sum(CASE WHEN NOT bad THEN CAST(o_totalprice AS decimal(20,2)) END) AS price,
          max(CASE WHEN NOT bad THEN CAST(o_orderdate AS date) END) AS newest
        FROM (SELECT *, o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' AS bad,
          CASE WHEN o_orderkey % 2 = 0 THEN 'say "so", then' END AS note FROM orders) GROUP BY 1""",
    "sql_parsers": """SELECT rendered, n, landed, attempted, landed * 60 + attempted AS seconds, share FROM (
        SELECT CASE WHEN l_linenumber = 7 THEN '---' ELSE concat(CAST(l_quantity AS int), ' of ', l_linenumber) END AS rendered,
          CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS int) END AS landed,
          CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS int) END AS attempted,
          CASE WHEN l_tax <> 0 THEN round(l_discount * 100) / 100.0::DOUBLE END AS share, count(*) AS n
        FROM lineitem GROUP BY ALL)""",
    "sql_latest": """SELECT 'now' AS as_of, user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
        UNION ALL
        SELECT 'then', user_id, event_id, event_type FROM events WHERE ts <= TIMESTAMP '2024-01-10 12:00:00'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "sql_unpivot": _with(body="""SELECT bout_url, 'a' AS corner, fighter_a_url AS fighter_url, fighter_b_url AS opponent_url,
          fighter_a_knockdowns AS knockdowns FROM stg_bouts
        UNION ALL SELECT bout_url, 'b', fighter_b_url, fighter_a_url, fighter_b_knockdowns FROM stg_bouts"""),
    "load_report": """SELECT run, rows_loaded, loaded_any, true AS skipped_the_rest FROM (
        SELECT 1 AS run, count(*) AS rows_loaded, true AS loaded_any FROM events
        UNION ALL SELECT 2, 0, false
        UNION ALL SELECT 3, count(*), true FROM events WHERE event_type = 'error')""",
    "load_ledger": "SELECT CAST(ts AS date) AS dt, count(*) AS row_count FROM events GROUP BY 1",
    "resume_landing": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'",
    "schema_evolution": """SELECT CAST(o_orderkey AS varchar) AS o_orderkey, o_orderstatus,
        CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderstatus = 'F' THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS dt FROM orders""",
    "stamp_lineage": """SELECT CAST(event_id AS varchar) AS event_id, concat('event/', event_id) AS _source_url,
        concat('{"event_id":"', event_id, '","event_type":"', event_type, '","props":',
          CASE WHEN event_type = 'error' THEN 'null' ELSE concat('"', replace(props, '"', '\\"'), '"') END, '}')
          AS _raw_payload, true AS has_batch, true AS has_time FROM events""",
    # web pages
    "pages_triage": """SELECT page_id, CASE WHEN contains(html, '<html lang="de">') THEN 'interstitial'
        WHEN contains(html, 'Checking your browser') THEN 'challenge' ELSE 'real' END AS kind FROM pages""",
    "pages_links": _LINKS,
    "pages_headings": _elements("h1"),
    "pages_paragraphs": _elements("p"),
    "pages_listing": _raw("SELECT event_name, event_date, event_location, event_url FROM raw_events"),
    "pages_card": _raw("""SELECT bout_url, winner_name, weight_class, coalesce(result, 'win') AS result FROM (
        SELECT * REPLACE (CASE WHEN result IN ('draw', 'nc') THEN result
          WHEN result IS NULL AND winner_name = 'nc' THEN fighter_a_name ELSE winner_name END AS winner_name)
        FROM current_bouts)"""),
    "pages_card_quarantine": _raw("""SELECT DISTINCT concat('card/', id // 2 // 20) AS url,
        'lists of unequal length' AS reason FROM current_bouts WHERE weight_class = 'Class 3'"""),
    "pages_box": _raw(f"""SELECT bout_url AS url, {_BOX_COLUMNS},
        concat('http://www.', fighter_a_url) AS fighter_a_url, concat('http://www.', fighter_b_url) AS fighter_b_url,
        method, finish_round, finish_time FROM current_bouts"""),
    "pages_quarantine": _raw("""SELECT url, CASE WHEN reason IS NOT NULL THEN 'quarantine' WHEN n = 0 THEN 'skip'
          ELSE 'ok' END AS status, reason
        FROM (SELECT bout_url AS url, n, CASE WHEN id % 13 <> 0 AND id % 11 = 0 THEN 'no summary'
            WHEN n > 20 THEN 'more cells than columns' WHEN n = 19 THEN 'fewer cells than columns' END AS reason
          FROM (SELECT *, CASE WHEN id % 13 = 0 THEN 0 WHEN id % 5 = 0 THEN 19 WHEN id % 7 = 0 THEN 21
            ELSE 20 END AS n FROM current_bouts))"""),
    "pages_profile": _raw("""SELECT fighter_url AS url, * EXCLUDE (u, fighter_url, first_name, last_name, reach),
        'Name' AS first_name, CAST(u AS varchar) AS last_name, CASE WHEN reach <> '--' THEN reach END AS reach
        FROM raw_fighters"""),
    "pages_skipped": _raw("""SELECT url, reason, count(*) AS n FROM (
        SELECT 'list/' || n AS url, CASE n % 5 WHEN 0 THEN 'no table' WHEN 1 THEN 'no rows' ELSE
            CASE WHEN n % 7 = 0 THEN 'a row of one cell' END END AS reason
        FROM (SELECT date_diff('day', DATE '1970-01-01', CAST(substr(event_url, 7) AS DATE)) AS n FROM raw_events)
        UNION ALL
        SELECT DISTINCT 'index/' || u // 20, CASE WHEN u // 20 % 5 = 0 THEN 'no table' ELSE 'no rows' END
        FROM raw_fighters WHERE u // 20 % 5 < 2
        UNION ALL
        SELECT 'index/' || u // 20, 'a row of one cell' FROM raw_fighters WHERE u // 20 % 5 > 1 AND u % 7 = 0)
      WHERE reason IS NOT NULL GROUP BY ALL"""),
    "pages_references": """SELECT concat('part/', p_partkey) AS url,
        concat(p_name, ' & ', p_type, ' <', p_brand, ' é♥', chr(10), '&unknown; ’') AS text FROM part""",
    "bronze_events": _raw("""SELECT event_name, event_date, event_location, event_url, concat('list/',
        date_diff('day', DATE '1970-01-01', CAST(substr(event_url, 7) AS DATE)) // 20) AS _source_url FROM raw_events"""),
    "pages_index": _raw("SELECT first_name, last_name, fighter_url AS link FROM raw_fighters"),
    "bronze_bouts": _raw(f"""SELECT bout_url, concat('card/', id // 2 // 20) AS event_url, weight_class,
        CASE WHEN result IS NULL AND winner_name = 'nc' THEN fighter_a_name ELSE winner_name END AS winner_name,
        coalesce(result, 'win') AS result, {_BOX_COLUMNS}, concat('http://www.', fighter_a_url) AS fighter_a_url,
        concat('http://www.', fighter_b_url) AS fighter_b_url, method, finish_round, finish_time,
        bout_url AS _source_url
      FROM current_bouts WHERE id % 13 <> 0 AND id % 11 <> 0 AND id % 5 <> 0 AND id % 7 <> 0"""),
    "bronze_fighters": _raw("""SELECT fighter_url, * EXCLUDE (u, fighter_url, last_name, reach),
        CAST(u AS varchar) AS last_name, CASE WHEN reach <> '--' THEN reach END AS reach,
        fighter_url AS _source_url FROM raw_fighters"""),
}

# The same results by another way.
ORACLES |= {f"{name}_sliced": ORACLES[name] for name in ("prior_rates", "feature_matrix")}
ORACLES |= {"pages_irregular": ORACLES["pages_box"], "pages_irregular_index": ORACLES["pages_index"]}
ORACLES |= {"published_marts": ORACLES["fct_bout"]}
