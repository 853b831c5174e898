"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over blocks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import save, small

#: A multiplier for the order of blocks; a prime above any number of blocks of a source.
STRIDE = 2_147_483_647
BITS = 60


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A non-null join key; null sources share the empty one."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def place(identity: Column, seed: str) -> Column:
    """A document's place in the random order of its source: 60 bits of a digest of its id."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(identity.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``target`` for each row of ``(key, source, source_size)``: one row a source.

    Sources in code point order (null last) take the weights in turn. ``share`` of all sizes is
    dealt by weight; what exceeds ``most`` times a source's size goes to the others by weight,
    until none is above. That end is found at once: in the order of size by weight the sources
    from which the level no longer exceeds the cap are not capped. Works on one row a source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    rows = sizes.withColumn("weight", turn).withColumn("cap", most * F.col("source_size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    open_ = F.col("level") * F.col("weight") <= F.col("cap")
    rows = rows.withColumn("level", F.min_by("level", F.when(open_, F.struct(F.col("cap") / F.col("weight"), "key"))).over(whole))
    level = F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))
    return rows.select("key", "source", "source_size", F.least("cap", level).alias("target"))


def _log_factorial(n: str) -> str:
    """ln n! as SQL: exact up to 20, then by Stirling's series."""
    x = f"CAST({n} AS DOUBLE)"
    series = f"{x} * ln({x}) - {x} + 0.5 * ln(2 * pi() * {x}) + 1 / (12 * {x}) - 1 / (360 * pow({x}, 3)) + 1 / (1260 * pow({x}, 5))"
    return f"(CASE WHEN {n} <= 20 THEN ln(factorial(CAST(greatest({n}, 0) AS INT))) ELSE {series} END)"


def hypergeometric(total: str, good: str, drawn: str, u: str) -> str:
    """SQL for one draw: how many of ``good`` of ``total`` are among ``drawn``, by inverting the
    distribution at ``u`` in (0, 1). The sum runs over all values within nine deviations."""
    mean = f"(CAST({drawn} AS DOUBLE) * {good} / {total})"
    spread = f"sqrt({mean} * (1 - CAST({good} AS DOUBLE) / {total}) * ({total} - {drawn}) / greatest({total} - 1, 1))"
    low = f"greatest(0, {drawn} - ({total} - {good}), CAST(floor({mean} - 9 * {spread} - 9) AS BIGINT))"
    high = f"least({drawn}, {good}, CAST(ceil({mean} + 9 * {spread} + 9) AS BIGINT))"
    f = _log_factorial
    constant = f"({f(good)} + {f(f'({total} - {good})')} - {f(total)} + {f(drawn)} + {f(f'({total} - {drawn})')})"
    chance = (
        f"exp(s.c - {f('k')} - {f(f'({good} - k)')} - {f(f'({drawn} - k)')} - {f(f'({total} - {good} - {drawn} + k)')})"
    )
    return (
        f"CASE WHEN {total} <= 0 OR {drawn} <= 0 OR {good} <= 0 THEN 0L ELSE least({high}, aggregate(sequence({low}, {high}), "
        f"named_struct('c', {constant}, 'p', 0.0D, 'k', {low}), "
        f"(s, k) -> named_struct('c', s.c, 'p', s.p + {chance}, 'k', s.k + IF(s.p + {chance} < {u}, 1L, 0L)), s -> s.k)) END"
    )


def split_quotas(nodes: DataFrame, seed: str) -> DataFrame:
    """One level of the tree: a node (``first`` shard, ``shards``, ``quotas`` by source) becomes two.

    The left child serves half of the shards and draws its even part of the node's blocks without
    replacement: how many come from each source is a multivariate-hypergeometric draw, made source
    by source as hypergeometric ones. The right child gets the rest, so quotas are kept exactly.
    """
    pick = hypergeometric("a.total", "q.n", "a.drawn", "q.u")
    uniform = f"(CAST(pmod(xxhash64('{seed}', first, shards, i), 9007199254740992) AS DOUBLE) + 0.5) / 9007199254740992"
    numbered = f"transform(quotas, (n, i) -> named_struct('n', n, 'u', {uniform}))"
    start = (
        "named_struct('total', aggregate(quotas, 0L, (a, n) -> a + n), 'drawn', "
        "CAST(round(aggregate(quotas, 0L, (a, n) -> a + n) * (shards div 2) / shards) AS BIGINT), 'out', CAST(array() AS ARRAY<BIGINT>))"
    )
    step = (
        "(a, q) -> aggregate(array(" + pick + "), a, (b, x) -> "
        "named_struct('total', b.total - q.n, 'drawn', b.drawn - x, 'out', concat(b.out, array(x))))"
    )
    left = F.expr(f"aggregate({numbered}, {start}, {step}, a -> a.out)")
    halves = F.expr(
        "CASE WHEN shards = 1 THEN array(named_struct('first', first, 'shards', shards, 'keys', keys, 'quotas', quotas)) ELSE array("
        "named_struct('first', first, 'shards', CAST(shards div 2 AS INT), 'keys', keys, 'quotas', left), "
        "named_struct('first', CAST(first + shards div 2 AS INT), 'shards', CAST(shards - shards div 2 AS INT), 'keys', keys, "
        "'quotas', zip_with(quotas, left, (n, x) -> n - x))) END"
    )
    return nodes.withColumn("left", F.when(F.col("shards") > 1, left)).select(F.inline(halves))


def _shards_of_draws(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """``(key, rank, shard)``: which shard takes the block at each rank of a source's drawn blocks."""
    names = quotas.agg(F.sort_array(F.collect_list(F.struct("key", "quota"))).alias("all"))
    nodes = names.select(
        F.lit(0).alias("first"), F.lit(shards).alias("shards"), F.col("all.quota").alias("quotas"), F.col("all.key").alias("keys")
    )
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        nodes = split_quotas(nodes, f"{seed}:{level}")
        if level % 4 == 3:  # spread the widening tree
            nodes = save(nodes.repartition("first"), "tree")
    leaves = nodes.select(
        F.col("first").alias("shard"), F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("quotas").alias("n")))
    )
    upto = F.sum("n").over(Window.partitionBy("key").orderBy("shard"))
    ranks = F.explode(F.sequence(F.col("upto") - F.col("n"), F.col("upto") - 1))
    return leaves.withColumn("upto", upto).where("n > 0").select("key", "shard", ranks.alias("rank"))


class Mix:
    """A mix of documents; build it with :func:`mix_sources`."""

    def __init__(self, sources: DataFrame, blocks: DataFrame, seed: str, shards: int):
        self.sources = sources  # key, source_size, target, bits
        self.blocks = blocks  # key, block, full, cut_pass, cut, shards
        self.seed = seed
        self.shards = shards

    def plan(self, docs: DataFrame, key: Column, at: Column) -> DataFrame:
        """``docs`` with ``mix_source_size``, ``mix_target`` and ``mix_shards``: an output shard for every time a row is taken."""
        rows = docs.withColumns({"mix_key": key, "mix_at": at})
        rows = rows.join(small(self.sources.withColumnRenamed("key", "mix_key")), "mix_key", "left")
        block = F.expr(f"shiftright(mix_at, {BITS} - mix_bits)")
        rows = rows.withColumn("mix_block", block).join(
            small(self.blocks.withColumnsRenamed({"key": "mix_key", "block": "mix_block"})), ["mix_key", "mix_block"], "left"
        )
        takes = F.when(F.col("mix_cut").isNull() | (F.col("mix_at") <= F.col("mix_cut")), F.size("mix_shards")).otherwise(
            F.size("mix_shards") - 1
        )
        taken = F.when(F.col("mix_shards").isNull(), F.array().cast("array<int>")).otherwise(F.slice("mix_shards", 1, takes))
        return rows.withColumn("mix_shards", taken).drop("mix_bits", "mix_cut", "mix_block", "mix_key")

    def rows(self, docs: DataFrame, key: Column, at: Column) -> DataFrame:
        """The mix itself: a row for each time a document is taken, one output partition a shard at
        the least, in random order within it."""
        plan = self.plan(docs, key, at).withColumn("mix_shard", F.explode("mix_shards"))
        order = F.xxhash64(F.lit(self.seed), "mix_shard", "mix_at")
        names = [c for c in docs.columns]
        return plan.repartition(self.shards, "mix_shard").sortWithinPartitions("mix_shard", order).select(*names)


def mix_sources(
    rows: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
    block_words: int = 1 << 16, shard_words: int = 1 << 23, seed: str = "mix",
) -> Mix:
    """Plan a mix of ``rows``: ``(key, source, size, at)``, one row a document, as a written table.

    Documents stand in a random order in their source (``at``), which is cut into blocks of about
    ``block_words`` words by leading bits of ``at``. A source's target takes its blocks in that
    order, once and then again up to ``most`` times; the last block is cut at the document that
    comes nearest. The drawn blocks of all sources are the quotas at the root of a tree whose
    leaves are output shards (see :func:`split_quotas`); each shard takes its own, disjoint part
    of a permutation of a source's drawn blocks. All is a function of ids and seed: reruns agree.

    Only sums by source and block are shuffled, partially summed first; a source with a third of
    all rows is many blocks. A document without words goes with its block and counts nothing; a
    source of none but such documents has no blocks and is left out. Rows that share an id share a
    place, and so are taken together. An empty table gives an empty mix.
    """
    sizes = rows.groupBy("key").agg(F.first("source", ignorenulls=True).alias("source"), F.sum("size").alias("source_size"))
    bits = F.ceil(F.log2(F.greatest(F.col("source_size") / block_words, F.lit(1.0)))).cast("int")
    sources = save(targets(sizes, weights, share, most).withColumn("bits", F.least(bits, F.lit(30))), "sources")
    total = sources.agg(F.sum("target")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_words))

    placed = rows.join(small(sources.select("key", "bits")), "key")
    placed = placed.withColumn("block", F.expr(f"shiftright(at, {BITS} - bits)"))
    sums = placed.where("size > 0").groupBy("key", "block").agg(F.sum("size").alias("words"))
    in_source = Window.partitionBy("key").orderBy("block")
    sums = sums.withColumns({
        "upto": F.sum("words").over(in_source), "number": F.row_number().over(in_source) - 1,
    }).join(sources.select("key", "source_size", "target"), "key")
    passes = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - passes * F.col("source_size")
    draws = passes + F.when(F.col("upto") - F.col("words") < rest, 1).otherwise(0)
    cuts = (F.col("upto") - F.col("words") < rest) & (F.col("upto") > rest)
    sums = save(sums.select("key", "block", "number", "upto", "words", draws.alias("draws"), cuts.alias("cuts"), rest.alias("rest")), "blocks")

    # The one block of a source in which its target ends: the last document that is nearer in than out.
    last = placed.where("size > 0").join(small(sums.where("cuts").select("key", "block", "upto", "words", "rest")), ["key", "block"])
    running = Window.partitionBy("key", "block").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("upto") - F.col("words") + F.sum("size").over(running) - F.col("size") / 2
    cut = last.withColumn("middle", middle).groupBy("key", "block").agg(
        F.coalesce(F.max(F.when(F.col("middle") <= F.col("rest"), F.col("at"))), F.lit(-1).cast("long")).alias("mix_cut")
    )

    quotas = save(sums.groupBy("key").agg(F.sum("draws").alias("quota"), F.count("*").alias("n")), "quotas")
    shard_of = _shards_of_draws(quotas.where("quota > 0").select("key", "quota"), shards, seed)
    drawn = sums.where("draws > 0").join(quotas, "key").select(
        "key", "block", "number", "n", "quota", F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("draws"))).alias("turn", "nth")
    )
    index = F.col("turn") * F.col("n") + F.col("number")
    drawn = drawn.withColumn("rank", F.pmod(index * F.lit(STRIDE) + F.lit(17), F.col("quota"))).join(shard_of, ["key", "rank"])
    chosen = drawn.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("turns"))
    blocks = chosen.join(cut, ["key", "block"], "left").select("key", "block", "mix_cut", F.col("turns.shard").alias("mix_shards"))
    kept = sources.select(
        "key", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("bits").alias("mix_bits")
    )
    return Mix(kept, save(blocks, "mix"), seed, shards)
