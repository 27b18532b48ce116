"""Values that decide results, written out, so that a slip in the tables shows."""

from sessionloom import config
from sessionloom.sources.blueprints import BLUEPRINTS
from sessionloom.sources.signals import SIGNALS


def test_signal_weights():
    weights = dict(SIGNALS)
    assert len(weights) == len(SIGNALS) == 38
    assert (weights["PURCHASE"], weights["CLICK_LINK"], weights["SUBSCRIBE"], weights["AUTO_PLAY"]) == (20, 6, 18, 4)
    assert sum(weights.values()) == 458


def test_blueprint_nodes():
    journeys = {n["name"]: n for n in BLUEPRINTS["UNIQUE_JOURNEYS"]["nodes"]}
    assert journeys["Welcome"]["batch_type"] == "biased" and journeys["Welcome"]["params"]["apply_threshold"] == 0.7
    assert journeys["Exploration"]["params"]["last_n"] == 8 and journeys["Hyper_Focus"]["params"]["last_n"] == 2
    curated = {n["name"]: n for n in BLUEPRINTS["USER_CENTRIC_PROMOTED_CONTENT_CURATIONS"]["nodes"]}
    assert curated["Exploration"]["params"]["n_topics"] == 8 and curated["Curated"]["params"]["apply_threshold"] == 0.6


def test_option_defaults():
    assert (config.BATCH_SIZE, config.QUANTIZER_TRAIN_SIZE, config.QUANTIZER_LEVELS) == (10, 100, 256)
    assert (config.CONFIDENCE_INTERVAL_RATIO, config.MINIMUM_TOPK, config.USER_EMBEDDINGS_LAST_N) == (0.15, 5, 50)
