"""Pages -> bronze records: flat, all text, with lineage.

Each function takes tables of fetched pages (``url``, ``html``) and returns
(records, quarantine). Interstitial pages go to quarantine first; a page that is
not what it should be never stops the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from antecede.sources import pages as p
from antecede.sources.landing import stamp_lineage


def _real(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    real, interstitial = p.drop_interstitials(pages)
    return real, interstitial.select("url", F.lit("interstitial").alias("reason"))


def bronze_events(listings: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Every event on the listing pages, upcoming ones included."""
    real, rejected = _real(listings)
    records, quarantine = p.extract_listing(real)
    fields = ["event_name", "event_date", "event_location", "event_url"]
    stamped = stamp_lineage(records, F.col("url"), batch_id, fields)
    return stamped.drop("url", "position"), quarantine.unionByName(rejected)


def bronze_bouts(cards: DataFrame, boxes: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """One record per bout: the card's outcome joined to the box score of the
    bout's own page. A bout without a box score is left out."""
    real_cards, rejected_cards = _real(cards)
    real_boxes, rejected_boxes = _real(boxes)
    listed, bad_cards = p.extract_card(real_cards)
    scores, bad_boxes = p.extract_box_score(real_boxes)
    scores = stamp_lineage(scores, F.col("url"), batch_id, [c for c in scores.columns if c != "url"])
    listed = listed.withColumnRenamed("url", "event_url").drop("position")
    records = listed.join(scores.withColumnRenamed("url", "bout_url"), "bout_url")
    quarantine = bad_cards.unionByName(bad_boxes).unionByName(rejected_cards).unionByName(rejected_boxes)
    return records, quarantine


def bronze_fighters(profiles: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """One record per profile page; the page's address is the fighter's key."""
    real, rejected = _real(profiles)
    records, quarantine = p.extract_profile(real)
    stamped = stamp_lineage(records, F.col("url"), batch_id, []).withColumn("_raw_payload", F.col("profile_json"))
    stamped = stamped.withColumnRenamed("url", "fighter_url").drop("profile_json")
    return stamped, quarantine.unionByName(rejected)
