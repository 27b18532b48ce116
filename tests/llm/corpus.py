"""Small invented documents with every awkward case, and brute-force versions."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use themselves.
    "h long, n_words long, kept boolean, sequence_id long, component_id long, sig binary, label long, shard int, ids binary, tokens long, node long"
)
SYLLABLES = "an the er on ti re in st en ou é ß ga co al de ñi ha wh".split()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def texts(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source) rows."""
    rng = random.Random(seed)
    passage = prose(rng, 90)
    base = prose(rng, 220)
    rows: list[tuple] = []

    def add(text, lang="en", source="a"):
        rows.append((len(rows), text, lang, source))

    for k in range(30):
        add(" ".join(prose(rng, rng.randint(1, 160))), rng.choice(["en", "fr"]), rng.choice("ab"))
    for k in range(12):  # near copies of one text
        own = list(base)
        for _ in range(k):
            own[rng.randrange(len(own))] = "changed" + str(rng.random())
        add(" ".join(own), source="hot")
    for _ in range(6):
        add(" ".join(base), source="hot")
        add(" ".join(base).upper().lower().replace(" ", "  "), source="hot")
    for k in range(8):  # a shared passage, whole or in part, at any place
        cut = passage[k * 3 :] if k % 2 else passage
        add(" ".join([*prose(rng, rng.randint(0, 60)), *cut, *prose(rng, rng.randint(0, 40))]), "fr", None)
    add(None)
    add("")
    add(" \t\n ", None)
    add("one")
    add("One two three", "fr")
    add("one  two\nthree")
    add("same " * 300)
    add("same " * 120 + "end")
    add("a b c\x1cd é́ 　x " + "<|endoftext|> it's 12,5% ## ### !!")
    add("\n".join([" ".join(passage[:20])] * 3 + ["", " ", "x"]), None, "b")
    add(" ".join(prose(rng, 6000)), "fr", "b")
    add("w" * 5000 + " " + "v" * 70)
    return rows


def frame(spark: SparkSession, rows: list[tuple], more: list[tuple] = ()) -> DataFrame:
    """The rows with extra columns; repeated rows and a null id on request."""
    all_rows = [*rows, *more]
    full = [(*r, len(r[1]) if r[1] is not None else None, 7, 8, False, 9, 10, b"x", 11, 12, b"y", 13, 14) for r in all_rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


AWKWARD = [(3, None, None, None), (None, "no id but some words here", "en", "a"), (None, None, None, None)]


def repeated(rows: list[tuple]) -> list[tuple]:
    """Some rows once more, and rows without id."""
    return [rows[0], rows[33], rows[33], *AWKWARD[1:]]


def shingles(text: str | None) -> frozenset:
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = words(lower)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def components(ids, links) -> dict:
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def repeated_words(w: list[str], n: int = 8) -> int:
    windows = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    covered = set()
    for i in range(len(w) - n + 1):
        if windows[tuple(w[i : i + n])] > 1:
            covered |= set(range(i, i + n))
    return len(covered)


def without_repeats(rows: list[tuple], window: int = 50) -> dict:
    """doc_id -> kept words and number of removed ones."""
    first: dict[tuple, int] = {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), doc_id)
    out = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc_id:
                gone[i : i + window] = [True] * window
        out[doc_id] = ([x for x, g in zip(w, gone) if not g], sum(gone))
    return out
