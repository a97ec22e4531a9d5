"""The pipeline on a small hand-written history."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from antecede.operators import ContractError
from antecede.plans import career, checks, features, marts, participants, serving, staging

T0 = dt.datetime(2026, 1, 1)


def bout(n, day, a, b, winner, result="win", method="KO/TKO", rnd="1", time="5:00", control=("1:00", "0:30"), **more):
    row = {
        "bout_url": f"b{n}",
        "event_url": f"e{day}",
        "fighter_a_url": a,
        "fighter_b_url": b,
        "fighter_a_name": a.upper(),
        "fighter_b_name": b.upper(),
        "winner_name": winner,
        "result": result,
        "weight_class": "Open",
        "method": method,
        "finish_round": rnd,
        "finish_time": time,
        "_ingested_at": T0,
    }
    for side, c in zip("ab", control):
        row |= {
            f"fighter_{side}_knockdowns": "0",
            f"fighter_{side}_sig_strikes": "10 of 20" if side == "a" else "4 of 9",
            f"fighter_{side}_sig_strike_acc": "50%" if side == "a" else "---",
            f"fighter_{side}_total_strikes": "11 of 21",
            f"fighter_{side}_takedowns": "1 of 2" if side == "a" else "0 of 0",
            f"fighter_{side}_takedown_acc": "50%" if side == "a" else "---",
            f"fighter_{side}_sub_attempts": "0",
            f"fighter_{side}_reversals": "0",
            f"fighter_{side}_control_time": c,
        }
    return row | more


HISTORY = [
    bout(1, 1, "x", "y", "X"),
    bout(2, 2, "x", "z", "X", method="Submission"),
    bout(3, 3, "z", "x", "X", method="Decision - Split"),
    bout(4, 4, "x", "y", "nc", result="nc", method="Overturned"),
    bout(5, 5, "x", "y", "X", method="DQ"),
    bout(6, 6, "y", "x", "draw", result="draw", method="Decision - Split"),
    bout(7, 7, "x", "w", "W", method="KO/TKO"),
    bout(8, 8, "x", "y", "X", result=None),
    bout(9, 99, "x", "y", "X"),
]
# An older version of a bout, and one more that is newer.
VERSIONS = [
    bout(1, 1, "x", "y", "Y", _ingested_at=T0 - dt.timedelta(days=1)),
    bout(2, 2, "x", "z", "X", method="Submission", rnd="2", _ingested_at=T0 + dt.timedelta(days=1)),
]


@pytest.fixture(scope="module")
def staged(spark):
    raw = spark.createDataFrame(HISTORY + VERSIONS)
    events = spark.createDataFrame(
        [(f"e{d}", f"Card {d}", f"January {d:02d}, 2026", "Las Vegas, Nevada, USA", T0) for d in range(1, 11)],
        "event_url string, event_name string, event_date string, event_location string, _ingested_at timestamp",
    )
    blank = {c: "1.5" if "min" in c or "average" in c else "40%" for c in (
        "sig_strikes_landed_per_min", "sig_strike_accuracy", "sig_strikes_absorbed_per_min", "sig_strike_defense",
        "takedown_average", "takedown_accuracy", "takedown_defense", "submission_average")}
    fighters = spark.createDataFrame(
        [
            dict(fighter_url=u, fighter_name=u.upper(), first_name=u.upper(), last_name="", height="5' 11\"",
                 weight="155 lbs.", reach="--", stance="Orthodox", dob=dob, _ingested_at=T0, **blank)
            for u, dob in (("x", "Jan 01, 2000"), ("y", "--"), ("z", "Feb 3, 1999"))
        ]
    )
    return (
        staging.stage_bouts(raw).cache(),
        staging.stage_events(events).cache(),
        staging.stage_fighters(fighters).cache(),
    )


@pytest.fixture(scope="module")
def rows(staged):
    bouts, events, _ = staged
    return participants.fighter_bouts(bouts, events, keep=["weight_class"]).cache()


def by_bout(df, fighter, *columns):
    found = df.filter(F.col("fighter_url") == fighter).orderBy("event_date").collect()
    return {r.bout_url: tuple(r[c] for c in columns) for r in found}


def test_staging(staged):
    bouts, events, fighters = staged
    assert bouts.count() == 9
    one, two = (bouts.filter(f"bout_url = 'b{n}'").first() for n in (1, 2))
    assert one.winner_fighter_url == "x" and two.finish_round == 2 and two.bout_duration_seconds == 600
    assert (one.fighter_a_sig_strikes_landed, one.fighter_a_sig_strikes_attempted) == (10, 20)
    assert one.fighter_b_sig_strike_accuracy_pct is None and one.fighter_b_takedowns_attempted == 0
    eight = bouts.filter("bout_url = 'b8'").first()
    assert not eight.is_draw and not eight.is_no_contest and eight.winner_fighter_url == "x"
    four = bouts.filter("bout_url = 'b4'").first()
    assert four.is_no_contest and four.winner_fighter_url is None and four.is_finish is None
    assert events.first().is_modern_era and events.filter("event_date = '2026-01-05'").count() == 1
    x = fighters.filter("fighter_url = 'x'").first()
    assert (x.height_inches, x.weight_lbs, x.reach_inches, x.last_name) == (71, 155, None, None)


def test_round_length_is_a_parameter(spark):
    raw = spark.createDataFrame([bout(1, 1, "x", "y", "X", rnd="3", time="0:10")])
    assert staging.stage_bouts(raw, round_seconds=180).first().bout_duration_seconds == 370


def test_participants(rows):
    # b9's event is unknown, so its rows are dropped.
    assert rows.count() == 16
    assert by_bout(rows, "x", "corner", "result", "is_winner")["b3"] == ("b", "win", True)
    assert by_bout(rows, "y", "result", "is_winner") == {
        "b1": ("loss", False),
        "b4": ("no_contest", None),
        "b5": ("loss", False),
        "b6": ("draw", False),
        "b8": ("loss", False),
    }
    assert by_bout(rows, "x", "sig_strikes_landed", "sig_strikes_absorbed")["b3"] == (4, 10)


def test_profiles_are_optional(rows, staged):
    profiled = participants.with_profile(rows, staged[2])
    assert profiled.count() == 16
    assert by_bout(profiled, "x", "age_at_bout_years")["b1"][0] == pytest.approx(9497 / 365.25)
    assert by_bout(profiled, "y", "age_at_bout_years")["b1"] == (None,)
    assert by_bout(profiled, "w", "stance") == {"b7": (None,)}


def test_career_pins(rows):
    model = career.career_to_date(rows)
    assert model.columns == list(career.COLUMNS)
    streaks = {k: v[0] for k, v in by_bout(model, "x", "prior_win_streak").items()}
    # A no contest (b4) is invisible, a draw (b6) and a loss (b7) end the streak.
    assert streaks == {"b1": 0, "b2": 1, "b3": 2, "b4": 3, "b5": 3, "b6": 4, "b7": 0, "b8": 0}
    records = by_bout(model, "x", "prior_bouts", "prior_wins", "prior_losses", "prior_draws")
    assert records["b1"] == (0, 0, 0, 0) and records["b8"] == (7, 4, 1, 1)
    last = {c: by_bout(model, "x", c)["b8"][0] for c in career.COLUMNS[8:]}
    assert last["prior_win_rate"] == 4 / 6
    assert last["prior_finish_rate"] == 2 / 4
    assert last["prior_minutes_fought"] == 40.0
    assert last["prior_avg_fight_minutes"] == 40.0 / 7
    assert last["prior_sig_strike_diff_per_min"] == (5 * 6 - 2 * 6) / 40.0
    assert last["prior_takedown_diff_per_15"] == (5 - 2) / (2400 / 900.0)
    assert last["prior_control_share"] == (5 * 60 + 2 * 30) / 2400
    assert all(by_bout(model, "x", c)["b1"][0] is None for c in career.COLUMNS[8:] if c != "prior_minutes_fought")


def test_career_is_the_same_in_slices(rows):
    plain = sorted(tuple(r) for r in career.career_to_date(rows, heavy=[]).select("bout_url", "fighter_url", "prior_win_streak", "prior_minutes_fought").collect())
    sliced = sorted(tuple(r) for r in career.career_to_date(rows, max_rows=2).select("bout_url", "fighter_url", "prior_win_streak", "prior_minutes_fought").collect())
    assert plain == sliced


def test_checks_pass_on_the_real_thing(staged, rows):
    bouts, events, fighters = staged
    model = career.career_to_date(rows).cache()
    assert checks.leakage(model, rows).count() == 0
    assert checks.debuts(model).count() == 0
    assert checks.ordinals(model).count() == 0
    assert checks.leakage(model.withColumn("prior_win_streak", F.col("prior_wins")), rows).count() > 0
    counts = {r.rule: r.violations for r in checks.q.rule_counts(checks.career_rules(model)).collect()}
    assert set(counts.values()) == {0}


def test_mart_checks_find_orphans(staged, rows):
    bouts, events, fighters = staged
    profiled = participants.with_profile(rows, fighters)
    rules = checks.mart_rules(
        marts.dim_event(events), marts.dim_fighter(fighters), marts.fct_bout(bouts, events), marts.fct_fighter_bout(profiled)
    )
    bad = {r.rule: r.violations for r in checks.q.rule_counts(rules).collect() if r.violations}
    # Fighter w has no profile: corner b and winner of b7.
    assert bad == {
        "fct_bout_fighter_b_sk": 1,
        "fct_bout_winner_fighter_sk": 1,
        "fct_fighter_bout_fighter_sk": 1,
        "fct_fighter_bout_opponent_fighter_sk": 1,
    }


def test_marts_hold_their_contracts(staged, rows):
    bouts, events, fighters = staged
    facts = marts.fct_bout(bouts, events)
    assert facts.columns == marts.FCT_BOUT.schema.fieldNames() and facts.count() == 8
    assert {r.is_draw for r in facts.filter("bout_url = 'b6'").collect()} == {True}
    keys = {r.fighter_url: r.fighter_sk for r in marts.dim_fighter(fighters).collect()}
    first = facts.filter("bout_url = 'b1'").first()
    assert first.winner_fighter_sk == first.fighter_a_sk == keys["x"]
    assert facts.filter("bout_url = 'b4'").first().winner_fighter_sk is None
    with pytest.raises(ContractError):
        marts.dim_event(events.withColumn("event_date", F.col("event_date").cast("string")))


def test_feature_matrix(staged, rows):
    profiled = participants.with_profile(rows, staged[2])
    wide = {r.bout_url: r for r in features.feature_matrix(profiled).collect()}
    assert len(wide) == 8 and "control_share_a" not in features.feature_matrix(profiled).columns
    five, six, seven = wide["b5"], wide["b6"], wide["b7"]
    assert (five.fighter_url_a, five.fighter_url_b, five.winner) == ("x", "y", "X")
    assert (wide["b4"].winner, six.winner, seven.winner) == ("nc", "draw", "W")
    assert (five.num_bouts_a, five.num_bouts_b, five.win_streak_a) == (4, 2, 3)
    assert five.win_percentage_a == 0.75 and five.finish_rate_a == 2 / 3
    assert five.strike_ratio_a == 34 / 22 and five.takedown_ratio_a == 3 / 1
    assert wide["b1"].strike_ratio_a is None and wide["b1"].finish_rate_a is None
    assert five.stance_a == "Orthodox" and seven.stance_b is None and five.weight_class_a == "Open"
    assert five.avg_fight_minutes_a == 25.0 / 4
    # Per bout: 0.2, 0.1, 0.1 (b3 from corner b), 0.2.
    assert five.avg_control_share_a == pytest.approx((0.2 + 0.1 + 0.1 + 0.2) / 4)


def test_legacy_rules(staged, rows):
    profiled = participants.with_profile(rows, staged[2])
    wide = {r.bout_url: r for r in features.feature_matrix(profiled, legacy=True, include_current=True).collect()}
    # The no contest ends the streak; the finish rate is over all bouts, 0 on a debut.
    assert wide["b5"].win_streak_a == 0 and wide["b4"].win_streak_a == 3
    assert wide["b5"].finish_rate_a == 2 / 4 and wide["b1"].finish_rate_a == 0.0
    assert wide["b5"].control_share_a == 0.2


def test_serving(staged):
    fighters = staged[2]
    assert [r.fighter_url for r in serving.fighter_list(fighters, 1, 2).collect()] == ["x", "y"]
    assert [r.fighter_url for r in serving.fighter_list(fighters, 2, 2).collect()] == ["z"]
    assert serving.fighter_lookup(fighters, "z").count() == 1
