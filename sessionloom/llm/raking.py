"""Mixing sources to target weights by iterative proportional fitting.

Token totals of all (source, language, topic) cells are raked until their sums agree
with a target for every value of every dimension; each document is then kept with its
cell's calibrated probability. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.config import BROADCAST_ROWS, stage

ROUNDS = 12
#: Rounds between two checkpoints of the cells.
STAGE_ROUNDS = 4
#: Default targets: shares in proportion to tokens to this power.
TEMPER = 0.9
#: Share of the tokens that the pipeline keeps.
KEPT_SHARE = 0.8
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"

#: The topic of a document as far as its text tells: tables, else by length in words.
TOPIC = (
    "CASE WHEN text LIKE '% | %' THEN 'table' WHEN _tokens < 100 THEN 'short' WHEN _tokens < 1000 THEN 'medium' ELSE 'long' END"
)
DIMENSIONS = {"source": "source", "lang": "lang", "topic": TOPIC}


def tempered(cells: DataFrame, name: str, power: float = TEMPER) -> DataFrame:
    """Target shares (value, share) of one dimension: token totals to a power."""
    totals = cells.groupBy(F.col(name).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("share"))
    return totals


def _together(cells: DataFrame) -> DataFrame:
    """Staged; a few cells lie in one partition, so that sums over them shuffle nothing."""
    cells = stage(cells)
    return cells.coalesce(1) if cells.count() <= BROADCAST_ROWS else cells


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Adds ``weight``, a share of all tokens, to cells (dimensions, ``tokens``).

    Shares are scaled to the values that occur with tokens; a value without a target
    gets none. Nulls are a value of their own.
    """
    out = cells.where("tokens > 0")
    for name, target in targets.items():
        target = target.select(F.col("value").alias("_value"), F.col("share").cast("double").alias(f"_to_{name}"))
        out = out.join(target, F.col(name).eqNullSafe(F.col("_value")), "left").drop("_value").fillna(0.0, [f"_to_{name}"])
    out = _together(out.withColumn("weight", F.col("tokens").cast("double")))
    for k in range(1, rounds + 1):
        for name in targets:
            inside = F.nullif(F.sum("weight").over(Window.partitionBy(name)), F.lit(0.0))
            out = out.withColumn("weight", F.coalesce(F.col("weight") * F.col(f"_to_{name}") / inside, F.lit(0.0)))
        if k % STAGE_ROUNDS == 0 or k == rounds:
            out = _together(out)
    total = out.agg(F.sum("weight")).first()[0] or 1.0
    return out.withColumn("weight", F.col("weight") / F.lit(total)).drop(*[f"_to_{name}" for name in targets])


def rake_to_share(cells: DataFrame, targets: dict[str, DataFrame], share: float, rounds: int = ROUNDS) -> DataFrame:
    """Adds ``weight``, the tokens kept of each cell, and ``ratio``, their share, to cells.

    Weights add up to ``share`` of all tokens. A cell whose weight would exceed its tokens
    is kept whole, and the others are raked again to what the targets leave them, until no
    further cell is full. A value of which all cells are full stays below its target; the
    other values take up what it lacks (``shortfall``).
    """
    cells = _together(cells.where("tokens > 0"))
    budget = share * (cells.agg(F.sum("tokens")).first()[0] or 0)
    goals = {name: _goal(cells, name, target, budget) for name, target in targets.items()}
    names = list(targets)
    free, full, left = cells, cells.limit(0), budget
    while True:
        rest = {}
        for name, goal in goals.items():
            held = full.groupBy(F.col(name).alias("_held")).agg(F.sum("tokens").alias("tokens"))
            joined = goal.join(held, F.col("value").eqNullSafe(F.col("_held")), "left")
            rest[name] = joined.select("value", F.greatest(F.col("goal") - F.coalesce("tokens", F.lit(0)), F.lit(0.0)).alias("share"))
        raked = rake(free, rest, rounds).withColumn("weight", F.col("weight") * F.lit(float(left)))
        raked = _together(raked.withColumn("ratio", F.col("weight") / F.col("tokens")))
        over = raked.where("ratio > 1")
        more = over.agg(F.sum("tokens")).first()[0]
        if more is None:
            whole = full.withColumns({"weight": F.col("tokens").cast("double"), "ratio": F.lit(1.0)})
            return raked.select(*names, "tokens", "weight", "ratio").unionByName(whole.select(*names, "tokens", "weight", "ratio"))
        full = _together(full.select(*names, "tokens").unionByName(over.select(*names, "tokens")))
        free = raked.where("ratio <= 1").select(*names, "tokens")
        left -= more


def _goal(cells: DataFrame, name: str, target: DataFrame, budget: float) -> DataFrame:
    """(value, goal): tokens that each value of a dimension should have of ``budget``."""
    values = cells.select(F.col(name).alias("_value")).distinct()
    here = target.join(values, F.col("value").eqNullSafe(F.col("_value"))).select("value", F.col("share").cast("double").alias("share"))
    total = here.agg(F.sum("share")).first()[0] or 1.0
    return stage(here.select("value", (F.col("share") * F.lit(budget / total)).alias("goal")))


def shortfall(raked: DataFrame, name: str, target: DataFrame) -> DataFrame:
    """(value, goal, kept) of one dimension after ``rake_to_share``, in tokens."""
    budget = raked.agg(F.sum("weight")).first()[0] or 0.0
    kept = raked.groupBy(F.col(name).alias("_kept")).agg(F.sum("weight").alias("kept"))
    goal = _goal(raked, name, target, budget)
    return goal.join(kept, F.col("value").eqNullSafe(F.col("_kept"))).select("value", "goal", "kept")


def uniform(key: Column, seed: int = SEED) -> Column:
    """A repeatable number in [0, 1) of 52 bits."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_probabilities(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    dimensions: dict[str, str] | None = None,
    rounds: int = ROUNDS,
    budget: int | None = None,
    seed: int = SEED,
    share: float | None = None,
) -> DataFrame:
    """``docs`` with ``_tokens``, ``_<dimension>``, ``_probability`` and ``_drawn``.

    Probabilities are as large as they can be without repeating a document, or less
    for a ``budget`` of tokens. With a ``share`` that part of the tokens is kept, and no
    cell's rarity scales the others (``rake_to_share``). Tokens are words. A null or empty text has none; cells
    without tokens weigh nothing and are kept. Rows with the same ``doc_id`` share
    their draw. Columns named like the new ones are replaced.
    """
    dimensions = dimensions or DIMENSIONS
    rows = docs.withColumn("_tokens", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    rows = rows.withColumns({f"_{name}": F.expr(sql) for name, sql in dimensions.items()})
    names = [f"_{name}" for name in dimensions]
    cells = stage(rows.groupBy(*names).agg(F.sum("_tokens").alias("tokens")))
    chosen = {f"_{name}": (targets or {}).get(name) for name in dimensions}
    chosen = {name: tempered(cells, name) if t is None else t for name, t in chosen.items()}
    if share is None:
        raked = stage(rake(cells, chosen, rounds).withColumn("ratio", F.col("weight") / F.col("tokens")))
    else:
        raked = stage(rake_to_share(cells, chosen, share, rounds))
    most, n = raked.agg(F.max("ratio"), F.count("*")).first()
    scale = 1.0 if share is not None else 1.0 / most if most else 0.0
    if budget is not None and share is None:
        scale = min(scale, float(budget))
    probability = raked.select(*[F.col(c).alias(f"_of{c}") for c in names], (F.col("ratio") * F.lit(scale)).alias("_probability"))
    if n <= BROADCAST_ROWS:
        probability = F.broadcast(probability)
    same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in names]
    joined = rows.drop("_probability").join(probability, same, "left").drop(*[f"_of{c}" for c in names])
    return joined.withColumn("_probability", F.coalesce("_probability", F.lit(1.0))).withColumn("_drawn", uniform(F.col("doc_id"), seed))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents drawn, with the columns of ``docs``, whatever the others are called.

    Null or empty texts weigh nothing and are kept; rows with the same ``doc_id``, null
    too, share their draw; an empty table stays empty.
    """
    # Only names with one line before them are used here.
    carried = {c: f"__{k}" if c.startswith("_") else c for k, c in enumerate(docs.columns)}
    plain = docs.select([F.col(f"`{c}`").alias(carried[c]) for c in docs.columns])
    out = mix_probabilities(plain, **options).where("_drawn < _probability")
    return out.select([F.col(carried[c]).alias(c) for c in docs.columns])


def oracle(rounds: int = ROUNDS, share: float = KEPT_SHARE) -> str:
    """The same in DuckDB SQL over ``documents``: one step of the recursion rakes the cells
    that are not full, and finds those that are now."""
    names = [f"_{n}" for n in DIMENSIONS]
    goals = [
        f"pow(sum(tokens) OVER (PARTITION BY {n})::DOUBLE, {TEMPER}) * {share} * (sum(tokens) OVER ())::DOUBLE / (SELECT sum(x) FROM "
        f"(SELECT pow(sum(tokens)::DOUBLE, {TEMPER}) AS x FROM cells WHERE tokens > 0 GROUP BY {n})) AS goal{n}"
        for n in names
    ]
    kept = [f"goal{n}" for n in names]
    left = [f"greatest(goal{n} - coalesce(sum(tokens) FILTER (WHERE full_cell) OVER (PARTITION BY {n}), 0), 0)::DOUBLE AS to{n}" for n in names]
    step = f"SELECT *, CASE WHEN full_cell THEN 0 ELSE tokens END::DOUBLE AS weight, {', '.join(left)} FROM raked WHERE more"
    for _ in range(rounds):
        for n in names:
            inside = f"sum(weight) OVER (PARTITION BY {n})"
            step = f"SELECT * REPLACE (CASE WHEN {inside} > 0 THEN weight * to{n} / {inside} ELSE 0 END AS weight) FROM ({step})"
    held = "coalesce(sum(tokens) FILTER (WHERE full_cell) OVER (), 0)"
    step = (
        f"SELECT * REPLACE (CASE WHEN full_cell THEN 1 ELSE weight / sum(weight) OVER () * (budget - {held}) / tokens END::DOUBLE AS ratio) "
        f"FROM ({step})"
    )
    columns = ", ".join([*names, "tokens", "budget", *kept])
    same = " AND ".join(f"p.{n} IS NOT DISTINCT FROM r.{n}" for n in names)
    steps = [
        "counted AS (SELECT *, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS _tokens FROM documents)",
        f"placed AS (SELECT doc_id, _tokens, {', '.join(f'{sql} AS _{n}' for n, sql in DIMENSIONS.items())} FROM counted)",
        f"cells AS (SELECT {', '.join(names)}, sum(_tokens) AS tokens FROM placed GROUP BY ALL)",
        f"wanted AS (SELECT {', '.join(names)}, tokens, {share} * (sum(tokens) OVER ())::DOUBLE AS budget, {', '.join(goals)} FROM cells WHERE tokens > 0)",
        f"raked AS (SELECT {columns}, false AS full_cell, 0::DOUBLE AS ratio, true AS more FROM wanted UNION ALL "
        f"SELECT {columns}, ratio >= 1 AS full_cell, least(ratio, 1) AS ratio, coalesce(bool_or(ratio > 1) OVER (), false) AS more FROM ({step}))",
        f"drawn AS (SELECT p.*, coalesce(r.ratio, 1.0) AS probability, "
        f"('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {1 << 52}::DOUBLE AS u "
        f"FROM placed p LEFT JOIN (SELECT * FROM raked WHERE NOT more) r ON {same})",
    ]
    return (
        f"WITH RECURSIVE {', '.join(steps)} SELECT doc_id, _source AS source, _lang AS lang, _topic AS topic, "
        "_tokens::BIGINT AS n_tokens, round(probability, 9) AS probability, u < probability AS kept FROM drawn"
    )
