"""Mixing sources to target weights with a splitting tree of exact block quotas.

Each source's documents are dealt into blocks by a hash. A target says how many words to take: whole passes over
the source, then blocks in a permuted order, the last one only in part (its smaller blocks, and of the
last of these its documents, in permuted order again), then a few single documents that fill the
gap. The block copies drawn are the tokens of an urn. A tree over the output shards splits the urn: at each node a random half of the tokens, of exact size, goes left, so the
counts per source follow a multivariate hypergeometric law and add up to the quotas. Rows are
then shuffled within their shard. Everything is DataFrame expressions; hashes stand in for random numbers, so reruns agree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    shards: int = 64
    blocks: int = 512
    #: Documents that fill the gap to a target are looked for in so many blocks after the last, so many times.
    reserve: int = 16
    fills: int = 6
    #: Words of a shard that are shuffled together.
    piece_words: int = 20_000_000
    seed: int = 7


def targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """Per source: its number, size, target in words and number of blocks.

    Sources by code point, null last, take the weights in turn. A target is the source's weight times a level, but at most
    ``most`` times its size; the level is where all targets together reach ``share`` of all sizes. One row
    per source, so the ordered windows see a table of sources only.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), (turn % len(mix.weights) + 1).cast("int"))
    numbered = sources.select("source", "source_size", turn.alias("sid"), weight.alias("weight"))
    top = (F.col("source_size") * mix.most).cast("double")
    full = Window.orderBy(F.col("top") / F.col("weight"), "sid")
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    poured = (
        numbered.withColumn("top", top)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("total") * mix.share - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("level", F.when(F.col("level") * F.col("weight") <= F.col("top"), F.struct(F.col("top") / F.col("weight"), F.col("sid"), "level")))
        .withColumn("level", F.min("level").over(everything)["level"])
    )
    words_per_block = F.greatest(F.col("total") / mix.blocks, F.lit(1.0))
    return poured.select(
        "source",
        "sid",
        "source_size",
        F.coalesce(F.least("top", F.col("level") * F.col("weight")), "top").alias("target"),
        F.greatest(F.lit(1), F.round(F.col("source_size") / words_per_block)).cast("long").alias("n_blocks"),
    )


def dealt(docs: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` (with doc_id, source) with sid, source_size, target, and the block and smaller block each row is dealt into."""
    at = F.xxhash64(F.lit(mix.seed), F.col("doc_id"))
    joined = docs.join(sources.withColumnRenamed("source", "source_name"), docs["source"].eqNullSafe(F.col("source_name")))
    return joined.drop("source_name").withColumns(
        {"block": F.pmod(at, F.col("n_blocks")), "smaller": F.pmod(F.xxhash64(F.lit(mix.seed + 1), F.col("doc_id")), F.lit(mix.blocks))}
    )


def passes() -> Column:
    """Whole passes over the source."""
    return F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")


def drawn(units: DataFrame, unit: str, seed: int, reserve: int = 0) -> DataFrame:
    """Which units (sid, unit, words, budget) of each source are taken in permuted order within its budget.

    ``state`` is 1 for a unit taken whole, 0 for the one after the last, of which ``left`` words may be taken, and -1 for
    the ``reserve`` units after that.
    """
    order = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(seed), "sid", unit), unit)
    upto = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = units.withColumns({"upto": upto, "rank": F.row_number().over(order)}).withColumn("before", F.col("upto") - F.col("words"))
    whole = F.count(F.when(F.col("upto") <= F.col("budget"), 1)).over(Window.partitionBy("sid"))
    found = found.withColumn("late", F.col("rank") - whole)
    state = (
        F.when(F.col("upto") <= F.col("budget"), 1).when(F.col("before") < F.col("budget"), 0).when(F.col("late") <= reserve + 1, -1)
    )
    return found.select("sid", unit, state.alias("state"), (F.col("budget") - F.col("before")).alias("left")).where("state is not null")


@dataclass(frozen=True)
class Plan:
    """The small tables that say what is taken, and where it goes. ``single`` has the documents taken once more by themselves."""

    sources: DataFrame
    blocks: DataFrame
    smaller: DataFrame
    single: DataFrame
    shards: DataFrame


def plan(sized: DataFrame, mix: Mix) -> Plan:
    """Draw the mix of ``sized`` (doc_id, source, size)."""
    sources = kept(targets(sized, mix), "sources")
    rows = dealt(sized, sources, mix)
    budget = (F.first("target") - F.first(passes()) * F.first("source_size")).alias("budget")
    in_blocks = kept(
        rows.groupBy("sid", "block").agg(F.sum("size").alias("words"), budget, F.first(passes()).alias("passes")), "block_words"
    )
    blocks = kept(drawn(in_blocks, "block", mix.seed, mix.reserve), "blocks")
    last = blocks.where("state = 0").select("sid", "block", F.col("left").alias("budget"))
    in_smaller = rows.join(last, ["sid", "block"]).groupBy("sid", "smaller").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
    smaller = kept(drawn(in_smaller, "smaller", mix.seed).where("state >= 0"), "smaller_blocks")

    # Of the last smaller block of each source, at most one in ``blocks`` squared of all rows, documents are taken one by one.
    marked = in_states(rows, blocks, smaller)
    edge = marked.where("block_state = 0 and smaller_state = 0").groupBy("sid", "doc_id", "block")
    edge = edge.agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    order = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(mix.seed + 2), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = kept(edge.withColumn("upto", F.sum("words").over(order)).where("upto <= left").select("sid", "doc_id", "block", "words"), "edge")

    fills = filled(with_copies(marked, edge), blocks, mix)
    return Plan(sources, blocks, smaller, kept(edge.unionByName(fills.drop("copy")), "single"), kept(split(in_blocks, blocks, fills, mix), "shards"))


def filled(rows: DataFrame, blocks: DataFrame, mix: Mix) -> DataFrame:
    """Single documents that fill the gaps to the targets: sid, doc_id, block, words, and which copy of its rows each makes.

    Each time every source takes the largest document of its last block and its reserve that its gap still holds and
    that may be taken once more. The candidates are a small part of all rows, the picks a few per source.
    """
    rows = kept(rows.select("sid", "doc_id", "block", "size", "target", "copies"), "copies")
    gaps = rows.groupBy("sid").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
    late = blocks.where("state <= 0").select("sid", "block")
    spare = rows.where("doc_id is not null").join(late, ["sid", "block"]).groupBy("sid", "doc_id", "block")
    spare = spare.agg(F.sum("size").alias("words"), F.max("copies").alias("copies"))
    spare = kept(spare.where((F.col("copies") < mix.most) & (F.col("words") > 0)).join(gaps, "sid"), "spare")
    spare = spare.withColumn("copy", F.col("copies") + 1)
    fills = spare.select("sid", "doc_id", "block", "words", "copy").limit(0)
    for _ in range(mix.fills):
        done = fills.groupBy("sid").agg(F.sum("words").alias("done"))
        open_ = spare.join(fills.select("sid", "doc_id"), ["sid", "doc_id"], "left_anti").join(done, "sid", "left")
        fits = open_.where(F.col("words") <= F.col("gap") - F.coalesce("done", F.lit(0)))
        pick = fits.groupBy("sid").agg(F.max(F.struct("words", (-F.col("doc_id")).alias("low"), "block", "copy")).alias("p"))
        picks = pick.select("sid", (-F.col("p.low")).alias("doc_id"), "p.block", "p.words", "p.copy")
        fills = kept(fills.unionByName(picks), "fills")
    return fills


def split(in_blocks: DataFrame, blocks: DataFrame, fills: DataFrame, mix: Mix) -> DataFrame:
    """The shard of every block copy drawn: sid, block, copy, shard.

    One row per node of the tree holds its tokens; a level of the tree is one projection. There are as many
    tokens as block copies drawn: a few times ``blocks``, and a few per source.
    """
    whole = in_blocks.where("passes > 0").select("sid", "block", F.explode(F.expr("sequence(1L, passes)")).alias("copy"))
    part = blocks.where("state >= 0").join(in_blocks.select("sid", "block", "passes"), ["sid", "block"])
    part = part.select("sid", "block", (F.col("passes") + 1).alias("copy"))
    # A fill may be a second copy of a row that its block, or the row alone, has taken already.
    extra = part.unionByName(fills.select("sid", "block", "copy")).distinct()
    urn = whole.unionByName(extra).agg(F.array_sort(F.collect_list(F.struct("sid", "block", "copy"))).alias("tokens"))
    nodes = urn.select(F.lit(0).alias("first"), F.lit(mix.shards).alias("width"), "tokens")
    wide, level = mix.shards, 0
    while wide > 1:
        level += 1
        keyed = F.transform("tokens", lambda t: F.struct(F.xxhash64(F.lit(mix.seed + level), F.col("first"), t).alias("key"), t.alias("t")))
        left_width = F.floor(F.col("width") / 2).cast("int")
        # The odd token out goes to either side by the level, so that it does not always go right.
        share = F.floor(F.size("tokens") * left_width / F.col("width") + (0.5 if level % 2 else 0.0)).cast("int")
        nodes = nodes.select("first", "width", left_width.alias("lw"), share.alias("n"), F.array_sort(keyed).alias("ordered")).select(
            F.explode(
                F.array(
                    F.struct(F.col("first"), F.col("lw").alias("width"), F.slice("ordered", F.lit(1), F.col("n")).alias("side")),
                    F.struct(
                        (F.col("first") + F.col("lw")).alias("first"),
                        (F.col("width") - F.col("lw")).alias("width"),
                        F.slice("ordered", F.col("n") + 1, F.size("ordered")).alias("side"),
                    ),
                )
            ).alias("node")
        )
        nodes = nodes.select("node.first", "node.width", F.transform("node.side", lambda x: x["t"]).alias("tokens")).where("width > 0")
        wide = (wide + 1) // 2
    return nodes.select(F.col("first").alias("shard"), F.explode("tokens").alias("token")).select("token.*", "shard")


def in_states(rows: DataFrame, blocks: DataFrame, smaller: DataFrame) -> DataFrame:
    """What ``dealt`` gives, with the states of each row's block and smaller block."""
    blocks = blocks.where("state >= 0").select("sid", "block", F.col("state").alias("block_state"))
    smaller = smaller.select("sid", "smaller", F.col("state").alias("smaller_state"), "left")
    return rows.join(blocks, ["sid", "block"], "left").join(smaller, ["sid", "smaller"], "left")


def with_copies(marked: DataFrame, single: DataFrame) -> DataFrame:
    """``copies``: how often a row is taken by whole passes, by its blocks, and by itself."""
    by_block = F.when((F.col("block_state") == 1) | ((F.col("block_state") == 0) & (F.col("smaller_state") == 1)), 1).otherwise(0)
    more = single.groupBy(F.col("sid").alias("of"), F.col("doc_id").alias("id")).agg(F.count("*").alias("alone"))
    rows = marked.join(more, (F.col("sid") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    copies = passes() + by_block + F.coalesce("alone", F.lit(0))
    return rows.withColumn("copies", copies).drop("of", "id", "alone", "block_state", "smaller_state", "left")


def placed(docs: DataFrame, drawn_plan: Plan, mix: Mix) -> DataFrame:
    """``docs`` (with doc_id, source) with what ``dealt`` adds and ``copies``, the times each row is taken; one pass over the rows."""
    marked = in_states(dealt(docs, drawn_plan.sources, mix), drawn_plan.blocks, drawn_plan.smaller)
    return with_copies(marked, drawn_plan.single)


def taken(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): size, its source's size and target, and the words the mix takes of it.

    A null text has no words, a null source is a source of its own. Rows that share a doc_id, or have none, fall into the same block.
    An empty table gives no rows. Other columns are not read.
    """
    sized = kept(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size")), "sized")
    rows = placed(sized, plan(sized, mix), mix)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows the mix takes of ``docs``, a row taken twice twice, in the order of their shards and shuffled within them.

    Columns are those of ``docs``, then ``shard``.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    narrow = packed.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.source").alias("source"), F.col("row.text").alias("text"))
    sized = kept(narrow.select("doc_id", "source", word_count().alias("size")), "sized")
    drawn_plan = plan(sized, mix)
    whole = packed.withColumns({"doc_id": F.col("row.doc_id").cast("long"), "source": F.col("row.source")})
    copies = placed(whole, drawn_plan, mix).where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    at = copies.join(drawn_plan.shards, ["sid", "block", "copy"])
    # A shard is cut by the order of its rows into pieces of bounded size, so no task holds a whole large shard.
    words = drawn_plan.sources.agg(F.sum("target")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1.0, words / mix.shards / mix.piece_words))))
    order = F.xxhash64(F.lit(mix.seed + 3), "doc_id", "copy")
    piece = F.shiftrightunsigned("order", 64 - bits) if bits else F.lit(0).cast("long")
    shuffled = at.withColumn("order", order).withColumn("piece", piece).repartition("shard", "piece")
    return shuffled.sortWithinPartitions("shard", "piece", "order").select("row.*", "shard")
