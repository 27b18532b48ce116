"""The trie of conversations' beginnings by ROLLUP over positional turn columns.

A conversation is cut into blocks of ``WIDTH`` turns; a block's row has one column per
position, and the node where the block before it ended. One ROLLUP over these columns
aggregates the prefixes of all blocks together, and ``grouping_id`` tells their depths.
A node is named by its depth and 128 bits of hashes of its turns and their positions,
combined by exclusive or, so that a block's beginning needs no walk along its conversation.

Sums over subtrees need no walk either. The smallest member of a node owns it. Who owns a
prefix owns all longer prefixes of its own, so a conversation's nodes are those from one
depth on, and a sum over the nodes of a subtree is a sum over members of what each of
them owns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.config import new_table_path
from sessionloom.operators.skew import salted_join

#: Positional columns of a block, and blocks of a conversation that are numbered together.
WIDTH = 4
STRETCH = 1024
#: Ids whose two to the power of this many neighbours are joined to one piece of text.
PIECE_BITS = 13

# A conversation begins with the first 0 to HEAD - 1 turns of the first of FAMILY.
HEAD = 4
FAMILY = 20
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, which cuts its lineage."""
    spark = df.sparkSession
    path = new_table_path(spark, f"prefixes-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _turns(conversations: DataFrame) -> DataFrame:
    """What is needed of each turn: its place, two hashes of role and text, and its words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(text, F.lit(1), role).alias("b"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
    )


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with their number among those of their conversation in the same partition.

    The order is dealt by ranges, so that one conversation may fill many partitions.
    """
    in_order = ["conv_id", F.asc_nulls_first("turn"), "a", "b"]
    dealt = turns.repartitionByRange(*in_order).withColumn("part", F.spark_partition_id())
    here = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "a", "b")
    return _written(dealt, "turns").withColumn("place", F.row_number().over(here).cast("long"))


def _rebuilt(ordered: DataFrame) -> DataFrame:
    """``conv_id, position, a, b, words`` of all rebuilt conversations, from position 1 on;
    one row at position 0 for a conversation without turns."""
    parts = ordered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    all_parts = Window.partitionBy("conv_id")
    earlier = all_parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "conv_id",
        "part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(all_parts).alias("own"),
        (F.crc32(F.col("conv_id").cast("string")) % HEAD).alias("skipped"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first_id"),
    )
    # Up to three turns of each partition can be among the first three.
    first = ordered.where((F.col("place") < HEAD) & (F.col("conv_id") % FAMILY == 0))
    heads = first.groupBy(F.col("conv_id").alias("first_id")).agg(
        F.slice(F.sort_array(F.collect_list(F.struct("part", "place", "a", "b", "words"))), 1, HEAD - 1).alias("head")
    )
    lead = F.coalesce(F.least(F.size("head").cast("long"), F.col("skipped")), F.lit(0))
    parts = parts.join(heads, "first_id", "left").withColumn("lead", F.when(F.col("head").isNull(), 0).otherwise(lead))
    parts = parts.withColumn("length", F.col("lead") + F.greatest(F.col("own") - F.col("skipped"), F.lit(0)))

    number = F.col("before") + F.col("place")
    kept = ordered.join(parts.select("conv_id", "part", "before", "skipped", "lead"), ["conv_id", "part"])
    kept = kept.where(number > F.col("skipped")).select(
        "conv_id", (number - F.col("skipped") + F.col("lead")).alias("position"), "a", "b", "words"
    )
    once = parts.where(F.col("before") == 0)
    led = once.where(F.col("lead") > 0).select(
        "conv_id", F.posexplode(F.slice("head", F.lit(1), F.col("lead").cast("int"))).alias("at", "turn")
    )
    led = led.select("conv_id", (F.col("at") + 1).cast("long").alias("position"), "turn.a", "turn.b", "turn.words")
    nothing = F.lit(None).cast("long")
    bare = once.where(F.col("length") == 0).select("conv_id", F.lit(0).cast("long").alias("position"), nothing.alias("a"), nothing.alias("b"), F.lit(0).cast("long").alias("words"))
    return kept.unionByName(led).unionByName(bare)


def _marks(position: Column, a: Column, b: Column) -> tuple[Column, Column]:
    """What a turn adds to the name of every prefix it is in."""
    return F.xxhash64(position, a, b), F.xxhash64(b, position, a)


def _xor(first: Column, second: Column) -> Column:
    return first.bitwiseXOR(second)


def _blocks(rebuilt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per block with its positional columns and the node it continues; and one
    row per conversation with the node it ends in."""
    before = F.greatest(F.col("position") - 1, F.lit(0))
    block = F.floor(before / WIDTH).cast("long")
    x, y = _marks(F.col("position"), F.col("a"), F.col("b"))
    turn = F.when(F.col("position") > 0, F.struct("a", "b", "words"))
    rows = rebuilt.select(
        "conv_id",
        F.floor(block / STRETCH).cast("long").alias("stretch"),
        block.alias("block"),
        (before % WIDTH).alias("slot"),
        turn.alias("turn"),
        F.when(F.col("position") > 0, x).otherwise(0).alias("x"),
        F.when(F.col("position") > 0, y).otherwise(0).alias("y"),
        "words",
        (F.col("position") > 0).cast("long").alias("n"),
    )
    totals = [F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("words").alias("words"), F.sum("n").alias("n")]
    slots = [F.max(F.when(F.col("slot") == k, F.col("turn"))).alias(f"t{k + 1}") for k in range(WIDTH)]
    # No more than STRETCH blocks meet; longer conversations are dealt by stretch.
    dealt = rows.repartition("conv_id", "stretch")
    blocks = dealt.groupBy("conv_id", "stretch", "block").agg(*totals, *slots)

    stretches = blocks.groupBy("conv_id", "stretch").agg(*totals)
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        "conv_id",
        "stretch",
        *(F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in "xy"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words0"),
        *(F.bit_xor(c).over(whole).alias(f"end_{c}") for c in "xy"),
        F.sum("words").over(whole).alias("all_words"),
        F.sum("n").over(whole).alias("length"),
    )
    inside = Window.partitionBy("conv_id", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.join(stretches.select("conv_id", "stretch", "x0", "y0", "words0"), ["conv_id", "stretch"]).select(
        "conv_id",
        "stretch",
        "block",
        *(_xor(F.col(f"{c}0"), F.coalesce(F.bit_xor(c).over(inside), F.lit(0))).alias(f"{c}0") for c in "xy"),
        (F.col("words0") + F.coalesce(F.sum("words").over(inside), F.lit(0))).alias("words0"),
        *(f"t{k + 1}" for k in range(WIDTH)),
    )
    ends = stretches.where(F.col("stretch") == 0).select("conv_id", "length", "end_x", "end_y", "all_words")
    return blocks, ends


def _rollup(blocks: DataFrame, sums: str) -> DataFrame:
    """``sums`` of every prefix, with its ``depth, x, y``, its parent's ``px, py`` and the
    words before its last turn."""
    slots = [f"t{k + 1}" for k in range(WIDTH)]
    # A column that is grouped by and empty belongs to a conversation that has ended before.
    real = [f"(level = {k + 1} AND t{k + 1} IS NOT NULL)" for k in range(WIDTH)]
    nodes = blocks.sparkSession.sql(
        f"""SELECT * FROM (
            SELECT block, x0, y0, {', '.join(slots)}, {WIDTH} - bit_count(grouping_id()) AS level, min(words0) AS words0, {sums}
            FROM {{blocks}} GROUP BY block, x0, y0, ROLLUP ({', '.join(slots)}))
        WHERE (level = 0 AND block = 0) OR {' OR '.join(real)}""",
        blocks=blocks,
    )

    def name(start: str, which: int, last: Column) -> Column:
        out = F.col(start)
        for k in range(WIDTH):
            position = F.col("block") * WIDTH + F.lit(k + 1).cast("long")
            mark = _marks(position, F.col(f"t{k + 1}.a"), F.col(f"t{k + 1}.b"))[which]
            out = _xor(out, F.when(F.lit(k + 1) <= last, mark).otherwise(0))
        return out

    level = F.col("level")
    earlier_words = [F.when(F.lit(k + 1) < level, F.col(f"t{k + 1}.words")).otherwise(0) for k in range(WIDTH)]
    aggregated = [c for c in nodes.columns if c not in {"block", "x0", "y0", "level", "words0", *slots}]
    return nodes.select(
        (F.col("block") * WIDTH + level).alias("depth"),
        name("x0", 0, level).alias("x"),
        name("y0", 1, level).alias("y"),
        name("x0", 0, level - 1).alias("px"),
        name("y0", 1, level - 1).alias("py"),
        sum(earlier_words, F.col("words0")).alias("words_before"),
        *aggregated,
    )


def _owners(nodes: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each conversation owns, and how many branches leave the nodes that have any.

    A branch is the first node a conversation owns; its parent belongs to another one.
    """
    first = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "words_before", "px", "py")).alias("first"))
    first = _written(first.select("conv_id", F.col("first.depth").alias("from_depth"), "first.words_before", "first.px", "first.py"), "owners")
    branches = first.where(F.col("from_depth") > 0).groupBy((F.col("from_depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"))
    branches = branches.agg(F.count(F.lit(1)).alias("n_branches"))
    parents = nodes.join(branches, ["depth", "x", "y"]).select(
        (F.col("depth") + 1).alias("from_depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent")
    )
    first = salted_join(first, parents, ["from_depth", "px", "py"], ["conv_id"], "left")
    owners = first.join(ends, "conv_id").select(
        "conv_id",
        "from_depth",
        "parent",
        (F.col("all_words") - F.col("words_before")).alias("owned_words"),
        F.col("length").alias("depth"),
        F.col("end_x").alias("x"),
        F.col("end_y").alias("y"),
    )
    leaf = F.col("n_branches").isNull().cast("long").alias("leaf")
    owners = owners.join(branches, ["depth", "x", "y"], "left").select("conv_id", "from_depth", "parent", "owned_words", leaf)
    return owners, branches


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which come one after another."""
    names = ["depth", "x", "y", "ends_sha256"]
    current, digest = None, None

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=names)

    for batch in batches:
        done = []
        for *node, piece in zip(*(batch.column(c).to_pylist() for c in ("depth", "x", "y", "piece")), strict=True):
            if node == current:
                digest.update(b",")
            else:
                if current is not None:
                    done.append((*current, digest.hexdigest()))
                current, digest = node, hashlib.sha256()
            digest.update(piece.encode())
        if done:
            yield rows(done)
    if current is not None:
        yield rows([(*current, digest.hexdigest())])


def _ends_digests(ends: DataFrame) -> DataFrame:
    """``depth, x, y, ends_sha256`` of the nodes where conversations end.

    Neighbouring ids are joined to pieces of bounded size before a node's pieces meet; a
    digest reads its whole list in order, so that one task streams through it, holding one
    piece at a time.
    """
    node = [F.col("length").alias("depth"), F.col("end_x").alias("x"), F.col("end_y").alias("y")]
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy(*node, F.shiftright("conv_id", PIECE_BITS).alias("number")).agg(ids.alias("piece"))
    in_order = pieces.repartition("depth", "x", "y").sortWithinPartitions("depth", "x", "y", "number")
    return in_order.select("depth", "x", "y", "piece").mapInArrow(_hash_pieces, "depth long, x long, y long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations: ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn``, null first; turns of one number in the order of hashes of
    role and text, each repeated row being a turn of its own. Null roles and texts are
    empty. Rows without ``conv_id`` belong to no conversation; remainders of negative ids are
    SQL's, negative. Texts of any length count
    with all their words but only travel as hashes of 128 bits. Conversations may have any
    number of turns. Other columns are not read; an empty table gives no rows.
    """
    blocks, ends = _blocks(_rebuilt(_ordered(_turns(conversations))))
    blocks, ends = _written(blocks, "blocks"), _written(ends, "ends")
    nodes = _rollup(blocks, "min(conv_id) AS conv_id").select("depth", "x", "y", "px", "py", "words_before", "conv_id")
    owners, branches = _owners(_written(nodes, "nodes"), ends)

    known = ends.join(owners, "conv_id", "left").withColumn(
        "stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / (WIDTH * STRETCH)).cast("long")))
    )
    known = known.select("conv_id", "stretch", "length", "all_words", "from_depth", "parent", F.coalesce("owned_words", F.lit(0)).alias("owned_words"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = """count(*) AS n_convs, min(struct(conv_id, from_depth, parent, owned_words, all_words, length)) AS owner,
        sum(all_words) AS all_words, sum(owned_words) AS owned_words, sum(leaf) AS n_leaves"""
    trie = _rollup(blocks.join(known, ["conv_id", "stretch"]), sums)
    trie = trie.join(branches, ["depth", "x", "y"], "left").join(_ends_digests(ends), ["depth", "x", "y"], "left")

    # Words of the subtree's nodes, once per member and once per node.
    per_member = F.col("all_words") - F.col("n_convs") * F.col("words_before")
    per_node = F.col("owned_words") - F.col("owner.owned_words") + F.col("owner.all_words") - F.col("words_before")
    depth = F.col("depth")
    return trie.select(
        F.col("owner.conv_id").alias("conv_id"),
        depth,
        F.when(depth > F.col("owner.from_depth"), F.col("owner.conv_id")).otherwise(F.col("owner.parent")).alias("parent_conv_id"),
        "n_convs",
        (F.coalesce("n_branches", F.lit(0)) + (F.col("owner.length") > depth).cast("long")).alias("n_children"),
        "n_leaves",
        (per_member - per_node).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
