"""Quality rules: a decision list learned from labelled text statistics.

Sequential covering (grow and prune) finds conjunctions of thresholds that single
out bad texts. The list is emitted as one ordered conditional Spark expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.words import Words, covered, text_slices

#: Labelled rows used for learning, those of the smallest hashes.
FIT_ROWS = 20_000
REPEAT_WORDS = 8

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_punct"]
COUNTS_SCHEMA = ", ".join(f"{c} long" for c in COUNTS)

#: Statistics the rules may test, as SQL over the counts.
FEATURES = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "punct_share": "n_punct / greatest(word_chars, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "words": "cast(n_words as double)",
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    seen: set[str] = set()
    n = 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\r\v\f"):
            n += 1
            seen.add(line)
    return n, n - len(seen)


def _repeated(words: Words) -> np.ndarray:
    """Words of each text that lie in an 8-word window found twice or more in it."""
    at, windows = words.windows(words.hashes(), REPEAT_WORDS)
    order = np.lexsort((windows, words.text[at]))
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = (windows[order[1:]] == windows[order[:-1]]) & (words.text[at[order[1:]]] == words.text[at[order[:-1]]])
    twice = at[order[same[1:] | same[:-1]]]
    flags = covered(len(words.starts), twice, REPEAT_WORDS)
    return np.bincount(words.text[flags], minlength=len(words.counts)).astype(np.int64)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts after the columns that are there."""
    for batch in batches:
        for part in text_slices(batch):
            texts = part.column("text")
            words = Words(texts)
            lead = (words.data & 0xC0) != 0x80
            # Latin capitals with marks: two bytes, the second one in 80..9E.
            marked = np.zeros(len(words.data), bool)
            marked[1:] = (words.data[:-1] == 0xC3) & (words.data[1:] <= 0x9E) & ~lead[1:]
            lines = np.array([_lines(t) for t in texts.to_pylist()], np.int64).reshape(-1, 2)
            columns = [
                words.counts,
                words.per_text(lead & words.inside),
                words.per_text(_SYMBOL[words.data]),
                lines[:, 1],
                _repeated(words),
                lines[:, 0],
                words.per_text(_UPPER[words.data] | marked),
                words.per_text(_DIGIT[words.data]),
                words.per_text(_PUNCT[words.data]),
            ]
            counts = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([*part.columns, *counts], names=[*part.schema.names, *COUNTS])


def text_stats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every whole text: a row for each row of ``docs``.

    A null or empty text has zeros; repeated rows are counted each by itself; other
    columns are not read.
    """
    schema = "doc_id long, text string, " + COUNTS_SCHEMA
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(_stats, schema).drop("text")


@dataclass(frozen=True)
class Rule:
    """All of the conditions (feature, is it a lower bound, threshold) hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def holds(self, x: pd.DataFrame) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, cut in self.conditions:
            out &= (x[name].to_numpy() > cut) if above else (x[name].to_numpy() <= cut)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, cut in self.conditions:
            out &= F.col(name) > F.lit(cut) if above else F.col(name) <= F.lit(cut)
        return out


def _grow(x: pd.DataFrame, bad: np.ndarray, max_conditions: int) -> Rule:
    """Adds the condition of the largest information gain while good rows remain."""
    rule, inside = Rule(()), np.ones(len(x), bool)
    while (~bad & inside).any() and len(rule.conditions) < max_conditions:
        p, n = (bad & inside).sum(), (~bad & inside).sum()
        best = (1e-9, None)
        for name in x.columns:
            values = x[name].to_numpy()
            order = np.argsort(values[inside], kind="stable")
            v, b = values[inside][order], bad[inside][order]
            edge = np.flatnonzero(v[1:] > v[:-1])
            if not len(edge):
                continue
            low_p, low_n = np.cumsum(b)[edge], np.cumsum(~b)[edge]
            for above, pp, nn in ((False, low_p, low_n), (True, p - low_p, n - low_n)):
                gain = pp * (np.log2(np.maximum(pp, 1e-12) / (pp + nn)) - np.log2(p / (p + n)))
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (name, above, float((v[edge[k]] + v[edge[k] + 1]) / 2)))
        if best[1] is None:
            break
        rule = Rule((*rule.conditions, best[1]))
        inside = rule.holds(x)
    return rule


def _prune(rule: Rule, x: pd.DataFrame, bad: np.ndarray) -> Rule:
    """The prefix of the conditions with the best worth on rows held back."""

    def worth(k: int) -> float:
        hit = Rule(rule.conditions[:k]).holds(x)
        p, n = (bad & hit).sum(), (~bad & hit).sum()
        return (p - n) / (p + n) if p + n else -1.0

    sizes = range(1, len(rule.conditions) + 1)
    return Rule(rule.conditions[: max(sizes, key=lambda k: (worth(k), -k))]) if rule.conditions else rule


def learn_rules(
    x: pd.DataFrame, bad: np.ndarray, precision: float = 0.95, max_rules: int = 24, max_conditions: int = 5, seed: int = 0
) -> list[Rule]:
    """An ordered list of rules that hold for bad rows; all others are good.

    A third of the rows left is held back for pruning each rule; a rule of less than
    ``precision`` on all of them ends the list. Without bad or good rows, no rules.
    """
    rules: list[Rule] = []
    draw = np.random.default_rng(seed)
    x, bad = x.reset_index(drop=True), np.asarray(bad, bool)
    while bad.any() and not bad.all() and len(rules) < max_rules:
        held = draw.random(len(x)) < 1 / 3
        rule = _grow(x[~held], bad[~held], max_conditions)
        rule = _prune(rule, x[held], bad[held])
        hit = rule.holds(x)
        if not rule.conditions or (bad & hit).sum() < max(2.0, precision * hit.sum()):
            break
        rules.append(rule)
        x, bad = x[~hit].reset_index(drop=True), bad[~hit]
    return rules


def with_features(stats: DataFrame) -> DataFrame:
    return stats.withColumns({name: F.expr(sql) for name, sql in FEATURES.items()})


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, **options) -> list[Rule]:
    """Rules from at most ``rows`` labelled documents (a documented bound).

    Labels that are null or contradict each other are left out, and so are labels
    of documents that are not there.
    """
    one = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    sample = one.where("quality = most and doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id", "quality")), "doc_id")
    stats = with_features(text_stats(known)).join(F.broadcast(sample.select("doc_id", "quality")), "doc_id")
    found = stats.select("doc_id", "quality", *FEATURES).orderBy("doc_id", *FEATURES).limit(2 * rows).toPandas()
    return learn_rules(found[list(FEATURES)].astype(float), (found["quality"] == 0).to_numpy(), **options)


def rule_number(rules: list[Rule]) -> Column:
    """The place of the first rule that holds, from 1; 0 if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        out = F.when(rule.column(), k) if out is None else out.when(rule.column(), k)
    return F.lit(0) if out is None else out.otherwise(0)


FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts, ``base_failed``, ``rule`` (the first one that holds) and ``kept``.

    Texts under 20 words, null and empty ones among them, or with more than 30 % of
    their words in repeated windows fail whatever the rules say.
    """
    out = with_features(text_stats(docs)).withColumn("base_failed", F.expr(FAILED)).withColumn("rule", rule_number(rules))
    return out.withColumn("kept", F.expr("not base_failed and rule = 0"))


def passing(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that pass, whatever their other columns are called."""
    names = docs.columns
    carried = {c: "text" if c == "text" else f"_column_{k}" for k, c in enumerate(names)}
    plain = docs.select([F.col(f"`{c}`").alias(carried[c]) for c in names])
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema] + [COUNTS_SCHEMA])
    judged = with_features(plain.mapInArrow(_stats, schema)).where(~F.expr(FAILED)).where(rule_number(rules) == 0)
    return judged.select([F.col(carried[c]).alias(c) for c in names])
