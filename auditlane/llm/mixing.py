"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets.  Sources, by code point and null last, weigh `weights` in turn and share
   `share` times all words; a target stops at `cap` times its source, and what is above is
   shared again by weight.  The resulting water level is the largest of (total - caps of
   the sources that fill up sooner) / (weight of the others).
2. Blocks.  A hash of the doc_id and the text deals a source's documents into blocks of about
   `BLOCK_ROWS`.  A target of r times its source takes every block floor(r) times, and then
   blocks in an order permuted by hash until the next would pass the target.  Of that one,
   the documents that fit are taken, largest first; what is then left goes on with the blocks behind
   it in the same way, until no document fits.  Documents longer than what is left count for nothing
   in a round.  The blocks drawn are the source's quota.
3. Tree.  The quotas of all sources are split between the two halves of the output shards
   by a draw without replacement (multivariate hypergeometric: the count of each source
   is random, the sums are exact), and each half is split again, down to single shards; for groups of
   `GROUP` sources first, then for the sources of each group.  A
   shard takes disjoint runs of each source's permuted blocks.
4. Local shuffle.  Inside a shard, copies are ordered by a hash of copy and document.

DataFrame operations only.  What is ever gathered in one row is a list of one integer for each of
`GROUP` sources or of all groups, and of one (size, count) per distinct size in one block; a source of a third of all rows is
summed per block before any window.  Every draw is a hash of fixed seeds, so reruns agree.

Defined cases: null source: a source of its own; null or empty text: size 0, takes no words
(its copies follow its block in whole passes and in the last one, if its source has words left to take there:
never more than the cap); rows that repeat a doc_id are dealt out by their texts, rows alike in both share a block; an empty table
gives an empty result; extra columns are kept by `mix` and ignored by `mix_plan`.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch, with_keys, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SHARDS = 16
BLOCK_ROWS = 512
MAX_BLOCKS = 65_536
GROUP = 512
SEED = 20_240


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, n_rows) -> the same with sid (place by code point) and target.

    The windows see one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("sid", F.row_number().over(order) - 1).withColumn(
        "_weight", F.element_at(cycle, F.col("sid") % len(weights) + 1))
    everything = Window.partitionBy(F.lit(0))
    filling = Window.partitionBy(F.lit(0)).orderBy("_ratio", "sid")
    level = (
        ranked.withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_before", F.sum("_cap").over(filling) - F.col("_cap"))
        .withColumn("_others", F.sum("_weight").over(everything) - F.sum("_weight").over(filling) + F.col("_weight"))
        .withColumn("_level", (F.col("_total") - F.col("_before")) / F.col("_others"))
    )
    target = F.least(F.col("_cap"), F.max("_level").over(everything) * F.col("_weight"))
    return level.withColumn("target", target).select("sid", "source", "source_size", "n_rows", "target")


def _uniform(*parts: Column) -> Column:
    """A hash of the parts as a number in [0, 1)."""
    return F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _draw(total: Column, left: Column, marked: Column, *where: Column) -> Column:
    """How many of `marked` blocks are among `left` drawn from `total`, one block at a time."""

    def step(state: Column, i: Column) -> Column:
        goes = (i > 0) & (_uniform(i, *where) * state["total"] < state["left"])
        return F.struct(
            (state["total"] - F.when(i > 0, 1).otherwise(0)).cast("long").alias("total"),
            (state["left"] - F.when(goes, 1).otherwise(0)).cast("long").alias("left"),
            (state["count"] + F.when(goes, 1).otherwise(0)).cast("long").alias("count"),
        )

    start = F.struct(total.cast("long").alias("total"), left.cast("long").alias("left"), F.lit(0).cast("long").alias("count"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), marked), start, step, lambda s: s["count"])


_QUOTAS = "array<struct<sid:int,quota:bigint>>"


def _split(nodes: DataFrame, shards: int, level: str) -> DataFrame:
    """(key, quotas, rooms) -> (key, shard, sid, quota): each row's quotas split so that shard k gets `rooms[k]` units."""
    nodes = nodes.select("key", "rooms", F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.col("quotas").cast(_QUOTAS).alias("quotas"))

    def deal(state: Column, x: Column) -> Column:
        got = _draw(state["total"], state["left"], x["quota"], F.lit(level), F.col("lo"), F.col("hi"), x["sid"])
        return F.struct(
            (state["total"] - x["quota"]).cast("long").alias("total"),
            (state["left"] - got).cast("long").alias("left"),
            F.concat(state["out"], F.array(got)).alias("out"),
        )

    add = lambda s, x: s + x
    for _ in range(max(0, ceil(log2(shards)))):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        start = F.struct(
            F.aggregate("quotas", F.lit(0).cast("long"), lambda s, x: s + x["quota"]).alias("total"),
            F.aggregate(F.slice("rooms", F.col("lo") + 1, mid - F.col("lo")), F.lit(0).cast("long"), add).alias("left"),
            F.array().cast("array<bigint>").alias("out"),
        )
        nodes = nodes.withColumn("got", F.aggregate("quotas", start, deal, lambda s: s["out"]))
        part = lambda f: F.zip_with("quotas", "got", lambda x, c: F.struct(x["sid"].alias("sid"), f(x, c).alias("quota")))  # noqa: E731,B023
        halves = F.array(
            F.struct(F.col("lo").alias("lo"), mid.alias("hi"), part(lambda x, c: c).alias("quotas")),
            F.struct(mid.alias("lo"), F.col("hi").alias("hi"), part(lambda x, c: x["quota"] - c).alias("quotas")),
        )
        whole = F.array(F.struct(F.col("lo").alias("lo"), F.col("hi").alias("hi"), F.col("quotas").alias("quotas")))
        nodes = nodes.select("key", "rooms", F.explode(F.when(F.col("hi") - F.col("lo") > 1, halves).otherwise(whole)).alias("n"))
        nodes = nodes.select("key", "rooms", "n.lo", "n.hi", "n.quotas")
    return nodes.select("key", F.col("lo").alias("shard"), F.inline("quotas"))


def split_quotas(quotas: DataFrame, shards: int) -> DataFrame:
    """(sid, quota) -> (sid, shard, quota): rows sum to the quotas, shards differ by at most 1.

    Two trees, one below the other, so that no row holds all sources.  The first splits the sums of groups of
    `GROUP` sources; then each group splits its own sources' quotas, by itself, into the sums it got.  Drawing
    the sums first and what makes them up after is the same draw.
    """
    bundle = lambda sid: F.array_sort(F.collect_list(F.struct(sid.cast("int").alias("sid"), F.col("quota"))))
    groups = quotas.groupBy(F.floor(F.col("sid") / GROUP).cast("int").alias("key")).agg(bundle(F.col("sid")).alias("quotas"), F.sum("quota").alias("units"))
    everything = groups.select(F.col("key").alias("sid"), F.col("units").alias("quota")).agg(bundle(F.col("sid")).alias("quotas"), F.sum("quota").alias("units"))
    share = lambda k: F.floor(k.cast("long") * F.col("units") / F.lit(shards)).cast("long")
    even = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: share(k) - share(k - 1))
    sums = _split(everything.select(F.lit(0).alias("key"), "quotas", even.alias("rooms")), shards, "groups")
    rooms = sums.groupBy(F.col("sid").alias("key")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("shard", "quota"))), lambda x: x["quota"]).alias("rooms"))
    return _split(groups.join(rooms, "key").select("key", "quotas", "rooms"), shards, "sources").select("sid", "shard", "quota")


def _fill(classes: Column, gap: Column) -> Column:
    """Of (size, count) classes, largest size first, how many of each fit into the gap."""

    def step(state: Column, x: Column) -> Column:
        fits = F.when(x["size"] > 0, F.floor(state["gap"] / x["size"])).otherwise(x["count"])
        take = F.least(x["count"], fits.cast("long"))
        return F.struct(
            (state["gap"] - take * x["size"]).alias("gap"),
            F.concat(state["out"], F.array(F.struct(x["size"].alias("size"), take.alias("take")))).alias("out"),
        )

    start = F.struct(gap.alias("gap"), F.array().cast("array<struct<size:bigint,take:bigint>>").alias("out"))
    return F.aggregate(F.sort_array(classes, asc=False), start, step, lambda s: s["out"])


def _last_pass(scratch: Scratch, dealt: DataFrame, blocks: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the pass that is not whole takes: (sid, block, limit, gap) and (sid, block, size, take).

    Of a block without a gap, the documents up to `limit` are taken, of one with a gap those of `picks`.  A
    round sums the blocks behind the last one with a gap, without documents that can't fit, and
    fills one block a source.  What didn't fit there is longer than what is left, so the next
    round leaves it and all longer ones out: in hash order, a few rounds.
    """
    ordered = Window.partitionBy("sid").orderBy("rank")
    # A source that is at its target has no last pass, not for its empty documents either.
    left = sources.where("rest > 0").select("sid", F.col("rest").alias("left"), F.lit(0).alias("after"))
    drawn = picks = None
    turn = 0
    while turn == 0 or not left.isEmpty():
        # Empty documents follow blocks of the first round, but are no reason to draw one later.
        fitting = dealt.select("sid", "block", "size").join(left, "sid").where("size <= left and (size > 0 or after = 0)")
        sums = fitting.groupBy("sid", "block").agg(F.sum("size").alias("words"))
        part = scratch.write(
            sums.join(blocks.select("sid", "block", "rank"), ["sid", "block"]).join(left, "sid").where("rank > after")
            .withColumn("_before", F.sum("words").over(ordered) - F.col("words"))
            .withColumn("full", F.col("_before") + F.col("words") <= F.col("left"))
            .where("full or _before < left")
            .select("sid", "block", "rank", F.col("left").alias("limit"), F.when(~F.col("full"), F.col("left") - F.col("_before")).alias("gap")),
            f"drawn{turn}")
        edge = part.where("gap is not null")
        classes = dealt.join(edge.select("sid", "block", "gap"), ["sid", "block"]).where("size <= gap").groupBy(
            "sid", "block", "size").agg(F.count(F.lit(1)).alias("count"), F.max("gap").alias("gap"))
        filled = classes.groupBy("sid", "block").agg(F.collect_list(F.struct("size", "count")).alias("classes"), F.max("gap").alias("gap"))
        some = scratch.write(filled.select("sid", "block", F.inline(_fill(F.col("classes"), F.col("gap")))), f"picks{turn}")
        used = some.groupBy("sid").agg(F.sum(F.col("size") * F.col("take")).alias("used"))
        rest = edge.join(used, "sid", "left").select(
            "sid", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("left"), F.col("rank").alias("after"))
        left = scratch.write(
            rest.join(blocks.select("sid", "rank", "least"), "sid").where("rank > after and least <= left")
            .select("sid", "left", "after").distinct(), f"left{turn}")
        drawn = part if drawn is None else drawn.unionByName(part)
        picks = some if picks is None else picks.unionByName(some)
        turn += 1
    return drawn, picks


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, shards: int = SHARDS,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, text_key, size, source_size, target, taken, shards.

    `shards` lists the output shard of each copy; `taken` is the number of copies times the size.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.write(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("text_key"),
    ), "rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    sources = scratch.write(
        targets(sizes, weights, share, cap)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("n_blocks", F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("n_rows") / F.lit(BLOCK_ROWS))).cast("int")),
        "sources")
    place = F.xxhash64(F.lit(SEED), F.col("doc_id").cast("string"), F.col("text_key"))
    dealt = rows.join(sources.select("sid", F.col("source").alias("_source"), "source_size", "target", "n_blocks"),
                      F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    dealt = dealt.withColumn("block", F.pmod(place, F.col("n_blocks")).cast("int")).drop("n_blocks")

    permuted = F.xxhash64(F.lit(SEED), "sid", "block")
    ordered = Window.partitionBy("sid").orderBy("_place", "block")
    blocks = scratch.write(
        dealt.groupBy("sid", "block").agg(F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
        .join(sources.select("sid", "whole"), "sid")
        .withColumn("_place", permuted)
        .withColumn("rank", F.row_number().over(ordered))
        .drop("_place"), "blocks")
    drawn, picks = _last_pass(scratch, dealt, blocks, sources)

    # A unit is one block in one pass; its number within the source follows pass and permutation.
    passes = F.explode(F.sequence(F.lit(0), F.col("whole"))).alias("turn")
    numbered = Window.partitionBy("sid").orderBy("turn", "rank")
    units = (
        blocks.join(drawn.select("sid", "block", "limit", "gap"), ["sid", "block"], "left")
        .select("sid", "block", "whole", "rank", "limit", "gap", passes)
        .where((F.col("turn") < F.col("whole")) | F.col("limit").isNotNull())
        .withColumn("unit", F.row_number().over(numbered) - 1)
    )
    units = scratch.write(units.select("sid", "block", "turn", F.col("unit").cast("long").alias("unit"), (F.col("turn") == F.col("whole")).alias("last"), "limit", "gap"), "units")
    quotas = units.groupBy("sid").agg(F.count(F.lit(1)).alias("quota"))
    upto = Window.partitionBy("sid").orderBy("shard")
    leaves = split_quotas(quotas, shards).withColumn("_end", F.sum("quota").over(upto)).where("quota > 0")
    runs = leaves.select("sid", "shard", F.explode(F.sequence(F.col("_end") - F.col("quota"), F.col("_end") - 1)).alias("unit"))
    homes = units.join(runs, ["sid", "unit"]).groupBy("sid", "block").agg(
        F.sort_array(F.collect_list(F.when(~F.col("last"), F.struct("turn", "shard")))).alias("sure"),
        F.max(F.when(F.col("last"), F.struct("turn", "shard"))).alias("maybe"),
        F.max("limit").alias("limit"),
        F.max("gap").alias("gap"),
    )
    homes = scratch.write(homes, "homes")
    placed = dealt.join(homes, ["sid", "block"], "left")

    # Of a block that fits in part, the documents that were picked; of the others, all that count.
    edge = placed.where("gap is not null")
    alike = Window.partitionBy("sid", "block", "size").orderBy("doc_id", "text_key")
    edge = edge.withColumn("_nth", F.row_number().over(alike)).join(picks, ["sid", "block", "size"], "left")
    sure = F.coalesce(F.col("sure"), F.array().cast("array<struct<turn:int,shard:int>>"))
    copies = lambda more: F.when(more, F.concat(sure, F.array("maybe"))).otherwise(sure)
    both = placed.where("gap is null").withColumn("copies", copies(F.col("size") <= F.col("limit"))).select(*_PLAN).unionByName(
        edge.withColumn("copies", copies(F.col("_nth") <= F.col("take"))).select(*_PLAN))
    return both.select(
        "doc_id", "source", "text_key", "size", "source_size", "target",
        (F.col("size") * F.size("copies")).cast("long").alias("taken"),
        F.transform("copies", lambda c: c["shard"]).alias("shards"),
    )


_PLAN = ["doc_id", "source", "text_key", "size", "source_size", "target", "copies"]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **options) -> DataFrame:
    """The mixed documents: one row per copy, with all columns, `mix_shard` and `mix_order`.

    Rows equal in doc_id, source and text stand for each other, so they are counted, not told apart.
    Written by shard and ordered by `mix_order` inside it, the copies are in mixed order.
    """
    plan = mix_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    plan, keys = with_keys(plan, id=F.col("doc_id"), source=F.col("source"), text=F.col("text_key"))
    copies = plan.where(F.size("shards") > 0).select(*keys, F.posexplode("shards").alias("__copy", "mix_shard"))
    keyed, _ = with_keys(docs, id=F.col(id_col), source=F.col(source_col), text=F.xxhash64(text_col))
    drawn = keyed.dropDuplicates(keys).join(copies, keys)
    order = F.xxhash64(F.lit(SEED), F.col("mix_shard"), F.col("__id"), "__copy")
    return drawn.select(*[keyed[c] for c in docs.columns], F.col("mix_shard"), order.alias("mix_order"))
