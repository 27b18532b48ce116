"""Signal vocabulary and the events that carry signals."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.config import broadcast_if_small, local_table
from sessionloom.operators.skew import salted_join

# Signal labels and weights.
SIGNALS = [
    ("DEFAULT", 1.0),
    ("ADD_TO_CART", 16.0),
    ("ITEM_VIEW", 10.0),
    ("APPLY", 18.0),
    ("PURCHASE", 20.0),
    ("HIGHLIGHT", 8.0),
    ("GLANCE_VIEW", 14.0),
    ("CAMPAIGN_CLICK", 6.0),
    ("CATEGORY_VISIT", 10.0),
    ("SHARE", 10.0),
    ("MERCHANT_VIEW", 10.0),
    ("REIMBURSED", 20.0),
    ("APPROVED", 18.0),
    ("REJECTED", 18.0),
    ("SHARE_ARTICLE", 10.0),
    ("COMMENT", 12.0),
    ("PERSPECTIVES_SWITCH", 8.0),
    ("REPOST", 20.0),
    ("SUBSCRIBE", 18.0),
    ("SHARE_PROFILE", 10.0),
    ("PAID_SUBSCRIBE", 20.0),
    ("SAVE", 8.0),
    ("FOLLOW_TOPIC", 10.0),
    ("WATCH", 20.0),
    ("CLICK_LINK", 6.0),
    ("RECOMMEND", 12.0),
    ("FOLLOW", 10.0),
    ("VISIT_PROFILE", 12.0),
    ("AUTO_PLAY", 4.0),
    ("SAVE_ARTICLE", 8.0),
    ("REPLAY", 20.0),
    ("READ", 14.0),
    ("LIKE", 8.0),
    ("CLICK_EMAIL_LINK", 6.0),
    ("ADD_TO_LIST", 12.0),
    ("FOLLOW_AUTHOR", 10.0),
    ("SEARCH", 15.0),
    ("CLICK_AD", 6.0),
]

BATCH = "BATCH"
DEFAULT = "DEFAULT"

DEFINITION = "label string, weight double"


def vocabulary(spark: SparkSession) -> DataFrame:
    """The built-in signals: ``(label, weight)``."""
    return local_table(spark, SIGNALS, DEFINITION)


def definitions_from_json(docs: DataFrame) -> DataFrame:
    """Signal definitions out of JSON texts ``(doc_ord, doc)``, in order.

    A text is a list of ``{label, weight}`` objects.
    """
    parsed = docs.select("doc_ord", F.posexplode(F.from_json("doc", f"array<struct<{DEFINITION}>>")))
    return parsed.select(F.struct("doc_ord", "pos").alias("ord"), "col.label", "col.weight")


def definitions_from_file(spark: SparkSession, path: str) -> DataFrame:
    """Definitions of a JSON file holding one list."""
    docs = spark.read.text(path, wholetext=True)
    return definitions_from_json(docs.select(F.lit(0).alias("doc_ord"), F.col("value").alias("doc")))


def definitions_from_list(spark: SparkSession, signals: list[dict]) -> DataFrame:
    doc = local_table(spark, [(0, json.dumps(signals))], "doc_ord int, doc string")
    return definitions_from_json(doc)


def load_signals(vocabulary: DataFrame, added: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Vocabulary plus added definitions ``(ord, label, weight)``; the last one wins.

    Labels are matched in upper case. ``scope`` names columns of ``added`` (such
    as the blueprint) the definitions are local to; the result then holds the
    added signals only, to be looked up before the vocabulary.
    """
    scope = scope or []
    latest = added.groupBy(*scope, F.upper("label").alias("label")).agg(F.max_by("weight", "ord").alias("weight"))
    if scope:
        return latest
    kept = vocabulary.join(latest.select("label"), "label", "left_anti")
    return kept.unionByName(latest)


def parse_actions(events: DataFrame, signals: DataFrame, scoped: DataFrame | None = None) -> DataFrame:
    """Resolve ``action`` texts: adds ``is_batch`` and, for signals, ``weight``.

    ``known`` is false where the action is neither BATCH nor a signal. ``scoped``
    holds signals of single blueprints, ``(blueprint, label, weight)``; an event's
    own blueprint (a column ``blueprint``) is asked before the vocabulary.
    """
    parsed = events.withColumn("action", F.upper("action"))
    signals = broadcast_if_small(signals)
    looked_up = parsed.join(signals, parsed["action"] == signals["label"], "left").drop("label")
    if scoped is not None:
        own = scoped.select("blueprint", F.upper("label").alias("action"), F.col("weight").cast("double").alias("_own"))
        looked_up = looked_up.join(broadcast_if_small(own), ["blueprint", "action"], "left")
        looked_up = looked_up.withColumn("weight", F.coalesce("_own", "weight")).drop("_own")
    is_batch = F.coalesce(F.col("action") == BATCH, F.lit(False))
    return looked_up.withColumn("is_batch", is_batch).withColumn("known", is_batch | F.col("weight").isNotNull())


def signal_guard(actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split actions into signals and everything a signal event must not carry."""
    ok = F.col("known") & ~F.col("is_batch")
    return actions.where(ok), actions.where(~ok)


def signal_item_join(signals_log: DataFrame, items: DataFrame) -> DataFrame:
    """Attach the signalled item's vector and history value; unknown items drop out.

    Items draw signals very unevenly, so popular ones are spread over slices.
    """
    vectors = items.select(F.col("id").alias("item_id"), "embedding", "history_value")
    return salted_join(signals_log, vectors, "item_id", ["session_id", "seq"])
