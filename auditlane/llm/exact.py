"""Exact dedup by deterministic block naming, in DataFrame operations only.

A text (A-Z lower-cased, null: empty) is cut into blocks of a fixed number of bytes.  A block's name
is two integers, its hash and its place, in sorted order, among the distinct blocks of that hash: equal blocks get
equal names, different blocks different ones, whatever the hash does.  Adjacent pairs
of names are then named the same way, level by level, until each text has one name
(the naming of Karp, Miller and Rosenberg).  The last of an odd count is paired with -1.  Level and name
are the text's identity: every text has one, and it depends on the texts alone, not on partitions.

Hashes are counted first.  A block whose hash occurs once is the only one of its kind and its place is 0;
only bodies whose hash occurs again are compared (copies combined before the shuffle), and only where
two of them differ do places have to be brought back to the blocks by their bodies.  Every level is a written table; the
upper levels hold integers only.

Defined cases: null and empty texts are equal; very long texts are many blocks, which no task has to hold together
beyond its own row; of equal texts the row with the largest
doc_id stays (null is smallest; of rows that repeat that doc_id exactly one); an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlane.llm.common import Scratch, ascii_lower, with_keys

BLOCK_BYTES = 8_192
NO_PARTNER = -1


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _named(scratch: Scratch, items: DataFrame, keys: list[str], level: int) -> DataFrame:
    """The items with `name` (hash, place) in place of their keys."""
    items = scratch.write(items.withColumn("_h", _hash(*[F.col(k) for k in keys])), f"items{level}")
    again = scratch.write(items.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"), f"again{level}")
    distinct = items.select("_h", *keys).join(again, "_h", "left_semi").groupBy("_h", *keys).agg(F.count(F.lit(1)).alias("_n"))
    # Different bodies of one hash, if there are any: the first keeps place 0, the others have theirs looked up.
    alike = Window.partitionBy("_h").orderBy(*keys)
    places = scratch.write(distinct.select("_h", *keys, (F.row_number().over(alike) - 1).alias("_place")).where("_place > 0"), f"places{level}")
    named = items.join(places, ["_h", *keys], "left")
    return named.withColumn("name", F.struct(F.col("_h").alias("hash"), F.coalesce("_place", F.lit(0)).alias("place"))).drop("_h", "_place", *keys)


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(row, doc_id, text_sha256, level, name): rows are equal iff (level, name) are; no row is without."""
    scratch = Scratch(docs.sparkSession, "exact")
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary").alias("body"),
    )
    n_blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / F.lit(block_bytes))).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), n_blocks - 1),
        lambda i: F.substring(F.col("body"), i * block_bytes + 1, F.lit(block_bytes)),
    )
    blocks = texts.select("row", "doc_id", F.sha2("body", 256).alias("text_sha256"), n_blocks.alias("n"),
                          F.posexplode(cut).alias("pos", "block"))
    first = scratch.write(_named(scratch, blocks, ["block"], 0), "level0")
    rows = first.where("pos = 0").select("row", "doc_id", "text_sha256", "n", "name")

    # Texts of one block have their identity; the others' names are paired, level by level.
    identity = rows.where("n = 1").select("row", "doc_id", "text_sha256", F.lit(0).alias("level"), "name")
    level, items = 0, first.where("n > 1").select("row", "n", "pos", "name")
    longest = items.agg(F.max("n")).first()[0] or 1
    many, done = rows.where("n > 1").select("row", "doc_id", "text_sha256"), []
    no_one = F.struct(F.lit(NO_PARTNER).cast("long").alias("hash"), F.lit(NO_PARTNER).alias("place"))
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        pairs = (
            items.groupBy("row", "n", F.shiftright("pos", 1).alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                 F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), no_one).alias("right"))
            .withColumn("n", F.shiftright(F.col("n") + 1, 1))
        )
        named = scratch.write(_named(scratch, pairs, ["left", "right"], level), f"level{level}")
        done.append(named.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
        items = named.where("n > 1")
    for part in done:
        identity = identity.unionByName(many.join(part, "row"))
    return identity


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "exact-groups")
    rows = scratch.write(identities(docs, block_bytes, id_col, text_col), "identities")
    groups = rows.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("_last"))
    # Written, so that the join below has plain shuffles on both sides and a large group can be split.
    groups = scratch.write(groups.where("group_size > 1"), "groups")
    last = lambda field, own: F.when(F.col("group_size").isNull(), own).otherwise(F.col(f"_last.{field}"))
    return rows.join(groups, ["level", "name"], "left").select(
        "doc_id", last("doc_id", F.col("doc_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (last("row", F.col("row")) == F.col("row")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_dedup(docs, block_bytes, id_col, text_col).where("kept")
    kept, keys = with_keys(kept, id=F.col("doc_id"), sha=F.col("text_sha256"))
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256)
    keyed, _ = with_keys(docs, id=F.col(id_col), sha=sha)
    # Rows that repeat one doc_id and text pass the join together; one of them stays.
    return keyed.join(kept.select(*keys), keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
