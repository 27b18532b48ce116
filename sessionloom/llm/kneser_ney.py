"""Language identification with interpolated Kneser-Ney character models.

Texts are read as lower-case letters with one boundary between runs of them, packed into
n-grams of 16 bits a symbol. All n-grams of all languages are kept, in tables dealt by
n-gram. The most frequent ones are broadcast with their log-probabilities; what a text has
besides is counted by its task and joined to the tables. The language of the lowest
cross-entropy per symbol wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.config import SCORE_DECIMALS, broadcast_if_small, local_table, stage
from sessionloom.llm.words import text_slices

ORDER = 4
BOUNDARY = 0x20
UNKNOWN = "und"
#: Most log-probabilities that are broadcast (n-grams of the highest order x languages).
MAX_CELLS = 4_000_000
#: Symbols beyond this number make a prediction no surer.
SURE_SYMBOLS = 60.0


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """The symbol of every code point: 0 if it is no letter; planes above the first are folded."""
    out = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = c if c < 0x10000 else 0xF000 | (c & 0xFFF)
    return out


def symbol_stream(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-grams ending at each symbol of each text, and the texts' limits.

    Each text starts after ORDER - 1 boundaries. A text without letters has no symbols.
    """
    pad = "\0" * (ORDER - 1)
    joined = "".join([pad + (t or "").replace("\0", " ").lower() for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    symbol, pads = _symbols()[codes], codes == 0
    letter = symbol > 0
    kept = letter | pads
    kept[1:] |= letter[:-1]
    pads, letter = pads[kept], letter[kept]
    symbol = np.where(letter, symbol[kept], BOUNDARY).astype(np.uint64)
    grams = np.zeros(len(symbol), np.uint64)
    for back in range(ORDER):
        grams[back:] |= symbol[: len(symbol) - back] << np.uint64(16 * back)
    heads = np.flatnonzero(pads)[:: ORDER - 1]
    ends = np.cumsum(~pads)
    limits = np.append(ends[heads], ends[-1])
    return grams[~pads], limits


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a partition, merged as they gather."""
    totals: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for part in text_slices(batch):
            texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
            for lang in set(langs):
                grams, _ = symbol_stream([t for t, own in zip(texts, langs) if own == lang])
                held = totals.setdefault(lang, [])
                held.append(np.unique(grams, return_counts=True))
                if len(held) > 8:
                    totals[lang] = [_merge(held)]
    for lang, held in totals.items():
        keys, counts = _merge(held)
        for k in range(0, len(keys), 1 << 16):
            part = keys[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.array(part.view(np.int64)), pa.array(counts[k : k + (1 << 16)])], names=["lang", "gram", "n"]
            )


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows with text and language."""
    rows = labelled.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    return rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Model:
    """Sorted n-grams and contexts of each order with log-probabilities by language, in memory."""

    langs: list[str]
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    unseen: np.ndarray

    def log_probability(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """A row for each n-gram, a column for each language."""
        at, hit = _find(self.grams[order - 1], grams)
        out = self.logs[order - 1][at]
        missed = np.flatnonzero(~hit)
        if len(missed):
            if order == 1:
                out[missed] = self.unseen
            else:
                part = grams[missed]
                low = part & np.uint64((1 << 16 * (order - 1)) - 1)
                place, known = _find(self.contexts[order - 1], part >> np.uint64(16))
                back = np.where(known[:, None], self.backoffs[order - 1][place], np.float32(0))
                out[missed] = back + self.log_probability(low, order - 1)
        return out

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean negative log-probability of each text's symbols by language; their numbers."""
        grams, limits = symbol_stream(texts)
        sizes = np.diff(limits)
        out = np.zeros((len(texts), len(self.langs)))
        some = np.flatnonzero(sizes)
        if len(some):
            logs = self.log_probability(grams)
            out[some] = -np.add.reduceat(logs, limits[:-1][some], axis=0, dtype=np.float64) / sizes[some, None]
        return out, sizes


def build_model(langs: list[str], grams: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated Kneser-Ney from counts (n-grams x languages) of the highest order.

    Lower orders count the distinct symbols before an n-gram; every order and language
    has its own discount n1 / (n1 + 2 n2).
    """
    levels = [(grams, counts.astype(np.float64))]
    for order in range(ORDER - 1, 0, -1):
        keys, c = levels[-1]
        low, inverse = np.unique(keys & np.uint64((1 << 16 * order) - 1), return_inverse=True)
        levels.append((low, np.stack([np.bincount(inverse, c[:, k] > 0, len(low)) for k in range(len(langs))], 1)))
    levels.reverse()
    model = Model(langs, [], [], [], [], np.zeros(len(langs)))
    below = None
    for order, (keys, c) in enumerate(levels, 1):
        n1, n2 = (c == 1).sum(0), (c == 2).sum(0)
        discount = np.where(n1 > 0, np.clip(n1 / np.maximum(n1 + 2 * n2, 1), 0.1, 0.95), 0.5)
        context, inverse = np.unique(keys >> np.uint64(16), return_inverse=True)
        total = np.stack([np.bincount(inverse, c[:, k], len(context)) for k in range(len(langs))], 1)
        types = np.stack([np.bincount(inverse, c[:, k] > 0, len(context)) for k in range(len(langs))], 1)
        back = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
        if order == 1:
            lower = np.full(c.shape, 1.0) / (types + 1)
            model.unseen = np.log(back[0] / (types[0] + 1)).astype(np.float32)
        else:
            at, _ = _find(model.grams[-1], keys & np.uint64((1 << 16 * (order - 1)) - 1))
            lower = below[at]
        below = np.maximum(c - discount, 0) / np.maximum(total[inverse], 1) + back[inverse] * lower
        model.grams.append(keys)
        model.logs.append(np.log(below).astype(np.float32))
        model.contexts.append(context)
        model.backoffs.append(np.log(back).astype(np.float32))
    return model


@dataclass
class SharedModel:
    """Probabilities of every order by n-gram, in tables; the frequent n-grams also in memory.

    ``seen[k]`` has (gram, logs) and ``contexts[k]`` (context, backs) of order ``k + 1``; both
    map a language's place to a number. ``grams[-1]`` and ``logs`` are what is broadcast.
    """

    langs: list[str]
    seen: list[DataFrame]
    contexts: list[DataFrame]
    unseen: list[float]
    grams: list[np.ndarray]
    logs: np.ndarray

    def resolve(self, wanted: DataFrame, order: int = ORDER) -> DataFrame:
        """``gram, logs`` for distinct n-grams: a log-probability for each language."""
        seen = self.seen[order - 1].select("gram", F.col("logs").alias("_own"))
        joined = wanted.select("gram").join(seen, "gram", "left")
        if order == 1:
            return joined.select("gram", F.transform(F.lit(self.unseen), lambda x, k: F.coalesce(F.try_element_at("_own", k), x)).alias("logs"))
        joined = stage(joined.withColumns({"_low": _suffix("gram", order - 1), "context": _context("gram")}))
        below = self.resolve(joined.select(F.col("_low").alias("gram")).distinct(), order - 1)
        joined = joined.join(self.contexts[order - 1], "context", "left")
        joined = joined.join(below.select(F.col("gram").alias("_low"), F.col("logs").alias("_below")), "_low")
        back = lambda k: F.coalesce(F.try_element_at("backs", k), F.lit(0.0))
        return joined.select("gram", F.transform("_below", lambda x, k: F.coalesce(F.try_element_at("_own", k), x + back(k))).alias("logs"))


def _suffix(gram: str, order: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << 16 * order) - 1))


def _context(gram: str) -> Column:
    return F.shiftrightunsigned(gram, 16)


def _by_lang(value: Column) -> Column:
    """A map with an entry for each language a group has."""
    return F.map_from_entries(F.collect_list(F.struct("lang", value)))


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The n-grams seen most over all languages, down to a power of two, at most ``most``."""
    totals = stage(counts.groupBy("gram").agg(F.sum("n").alias("n")))
    sizes = totals.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()
    power = {r.power: r["count"] for r in sizes}
    least = next((p for p in range(65) if sum(n for q, n in power.items() if q >= p) <= most), 65)
    return totals.where(F.floor(F.log2("n")) >= least).select("gram")


def fit(labelled: DataFrame, max_cells: int = MAX_CELLS) -> SharedModel | None:
    """The model of all languages in ``labelled`` (text, lang); None without any symbol.

    All n-grams of all texts are counted and kept. ``max_cells`` bounds what is broadcast;
    it decides where an n-gram is looked up, never its probability.
    """
    spark = labelled.sparkSession
    named = stage(gram_counts(labelled))
    langs = sorted(r.lang for r in named.select("lang").distinct().collect())
    if not langs:
        return None
    places = broadcast_if_small(local_table(spark, list(zip(langs, range(len(langs)))), "lang string, place int"))
    counts = named.join(places, "lang").select(F.col("place").alias("lang"), "gram", "n")
    levels = [counts.withColumnRenamed("n", "c")]
    for order in range(ORDER - 1, 0, -1):
        distinct = levels[-1].groupBy("lang", _suffix("gram", order).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
        levels.append(stage(distinct))
    levels.reverse()
    seen, contexts, unseen, lower = [], [], [0.0] * len(langs), None
    for order, level in enumerate(levels, 1):
        rows = []
        for r in level.groupBy("lang").agg(F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"), F.count("*").alias("types")).collect():
            discount = min(max(r.n1 / (r.n1 + 2 * r.n2), 0.1), 0.95) if r.n1 else 0.5
            rows.append((r.lang, discount, 1.0 / (r.types + 1)))
        discounts = broadcast_if_small(local_table(spark, rows, "lang int, discount double, uniform double"))
        level = level.withColumn("context", _context("gram"))
        inside = level.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count("*").alias("types")).join(discounts, "lang")
        inside = stage(inside.withColumn("back", F.col("discount") * F.col("types") / F.col("total")))
        joined = level.join(inside, ["lang", "context"])
        if order == 1:
            for r in inside.collect():
                unseen[r.lang] = float(np.log(r.back * r.uniform))
            joined = joined.withColumn("lower", F.col("uniform"))
        else:
            joined = joined.withColumn("low", _suffix("gram", order - 1)).join(lower, ["lang", "low"])
        p = F.greatest(F.col("c") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("back") * F.col("lower")
        level = stage(joined.select("lang", "gram", p.alias("p")))
        lower = level.select("lang", F.col("gram").alias("low"), F.col("p").alias("lower"))
        seen.append(stage(level.groupBy("gram").agg(_by_lang(F.log("p")).alias("logs"))))
        contexts.append(stage(inside.groupBy("context").agg(_by_lang(F.log("back")).alias("backs"))))
    model = SharedModel(langs, seen, contexts, unseen, [], np.zeros((0, len(langs)), np.float32))
    found = model.resolve(_frequent(counts, max_cells // len(langs))).withColumn("logs", F.col("logs").cast("array<float>")).toArrow()
    grams = found.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    logs = found.column("logs").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(langs))
    model.grams, model.logs = [grams[order]], logs[order]
    return model


PARTLY = "_row long, _sums array<double>, _size long, _letters boolean, _rest array<long>, _times array<long>"


def _lists(limits: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(limits, pa.int32()), values)


def _look_up(shared):
    """Sums over the broadcast n-grams of each text; its other n-grams with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs = shared.value
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text").to_pylist()
                grams, limits = symbol_stream(texts)
                sizes, n = np.diff(limits), len(texts)
                at, hit = _find(keys, grams) if len(keys) else (np.zeros(len(grams), np.int64), np.zeros(len(grams), bool))
                sums = np.zeros((n, logs.shape[1]))
                found = np.concatenate([[0], np.cumsum(hit)])[limits]
                some = np.flatnonzero(np.diff(found))
                if len(some):
                    sums[some] = np.add.reduceat(logs[at[hit]], found[:-1][some], axis=0, dtype=np.float64)
                missed = np.flatnonzero(~hit)
                owner = np.repeat(np.arange(n), sizes)[missed]
                pairs, times = np.unique(np.rec.fromarrays([owner, grams[missed]], names="owner,gram"), return_counts=True)
                cut = np.searchsorted(pairs["owner"], np.arange(n + 1))
                letters = [any(map(str.isalpha, t or "")) for t in texts]
                rest = pa.array(np.ascontiguousarray(pairs["gram"]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("_row"),
                        _lists(np.arange(n + 1) * logs.shape[1], pa.array(sums.ravel())),
                        pa.array(sizes, pa.int64()),
                        pa.array(letters, pa.bool_()),
                        _lists(cut, rest),
                        _lists(cut, pa.array(times, pa.int64())),
                    ],
                    names=["doc_id", "_row", "_sums", "_size", "_letters", "_rest", "_times"],
                )

    return run


def predict(docs: DataFrame, model: SharedModel | None) -> DataFrame:
    """``doc_id, lang_pred, score, entropy`` for each row of ``docs``.

    The score is the share of the likeliest language at no more than SURE_SYMBOLS
    symbols. Texts that are null or have no letter are ``und`` with score 0 and no
    entropy; so is everything without a model. Ties go to the first language by name.
    Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"))
    shared = docs.sparkSession.sparkContext.broadcast((model.grams[-1], model.logs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    partly = stage(docs.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(_look_up(shared), f"doc_id {kind}, {PARTLY}"))
    rest = partly.select("_row", F.explode(F.arrays_zip("_rest", "_times")).alias("of")).select("_row", F.col("of._rest").alias("gram"), "of._times")
    logs = model.resolve(rest.select("gram").distinct()).withColumn("logs", F.col("logs").cast("array<float>"))
    each = [F.sum(F.col("logs")[k].cast("double") * F.col("_times")) for k in range(len(model.langs))]
    more = rest.join(logs, "gram").groupBy("_row").agg(F.array(*each).alias("_more"))
    joined = partly.drop("_rest", "_times").join(more, "_row", "left")
    total = F.when(F.col("_more").isNull(), F.col("_sums")).otherwise(F.zip_with("_sums", "_more", lambda x, y: x + y))
    size = F.greatest("_size", F.lit(1))
    # Rounded, so that the order of a sum decides no tie.
    joined = joined.withColumn("_all", F.transform(total, lambda x: F.round(-x / size, SCORE_DECIMALS)))
    joined = joined.withColumn("_least", F.array_min("_all"))
    odds = F.transform("_all", lambda x: F.exp((F.col("_least") - x) * F.least(F.col("_size").cast("double"), F.lit(SURE_SYMBOLS))))
    score = 1 / F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    best = F.element_at(F.lit(model.langs), F.array_position("_all", F.col("_least")).cast("int"))
    return joined.select(
        "doc_id",
        F.when(F.col("_letters"), best).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_letters"), score).otherwise(0.0).alias("score"),
        F.when(F.col("_letters"), F.col("_least")).alias("entropy"),
    )


def with_rejection(predicted: DataFrame, quantile: float = 0.95, slack: float = 1.35) -> DataFrame:
    """Adds ``rejected``: the entropy is above what texts of that language have.

    The limit is a quantile over all texts predicted as that language, and some slack.
    """
    limits = predicted.groupBy("lang_pred").agg((F.percentile_approx("entropy", quantile, 10_000) * slack).alias("limit"))
    named = limits.withColumnRenamed("lang_pred", "_lang")
    # One row per language of the model.
    joined = predicted.join(F.broadcast(named), F.col("lang_pred") == F.col("_lang"), "left").drop("_lang")
    return joined.withColumn("rejected", F.coalesce(F.col("entropy") > F.col("limit"), F.lit(True))).drop("limit")
