"""A Merkle manifest of a dataset with a proof for every row, as nested structs rolled up by rank digits.

Rows of a group (a language, say) are ranked by id.  The rank is written in base ``ARITY``; its digits are grouped
away from the last one on, and each grouping nests the child structs of one node and hashes their digests.
``LEVELS`` digits are grouped away inside a block of ``ARITY ** LEVELS`` leaves, so a nested row has a bounded
size; the tops of the blocks are rolled up the same way, as the leaves of a smaller tree, until each group has one
node.  The tops of the groups, ordered by name, are the leaves of a last tree.  A final transform over each
block's nested structs explodes the leaves with their proofs; only block tops meet the proof above them
by a join, one row in ``ARITY ** LEVELS``.

No group is sorted or numbered in one task: rows are dealt by ranges of (group, id, digest), numbered inside
their range, and the counts of the ranges before are added.  Texts are read once, where they lie; digests,
ids and the named columns travel.

Defined results: NULL columns hash as ``-``; NULL ids come first; rows that share an id are ordered by their
digest, equal rows are leaves of their own; NULL is a group of its own and comes first; a lone leaf is its group's
top; an empty table has an empty manifest; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.session import staged

ARITY = 8
LEVELS = 3  # digits grouped away inside a block
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROW_BITS = 33  # of monotonically_increasing_id: the rest is the partition


def field(value: Column) -> Column:
    """A value framed by its length in UTF-8 bytes, so that no two rows spell the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """The digest of a row's framed values."""
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof in a row, left to right, level by level."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0 by ``order``, within ``grp``) and ``total``; no group is handled by one task."""
    own = rows.columns
    # The salt only parts equal rows, so that a range never has to hold all copies of one.
    dealt = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange("grp", *order, "_salt").sortWithinPartitions("grp", *order, "_salt")
    numbered = staged(dealt.drop("_salt").withColumn("_at", F.monotonically_increasing_id()), "dealt")
    numbered = numbered.withColumn("_part", F.shiftright("_at", ROW_BITS))
    ranges = numbered.groupBy("grp", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        F.col("grp").alias("_g"), F.col("_part").alias("_p"), (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy("grp")).alias("total")
    )
    met = numbered.join(offsets, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return met.select(*own, (F.col("_at") + F.col("_shift")).alias("rank"), "total")


def _digit(level: int) -> str:
    return f"_d{level}"


def nested(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """One row per block: ``grp``, ``block``, ``total`` (of blocks), ``top`` and the nested ``children``."""
    block = ARITY**LEVELS
    keys = ["grp", "block", "total"]
    rows = nodes.select(
        "grp", F.floor(F.col("rank") / block).alias("block"), "total",
        *[(F.floor(F.col("rank") / ARITY**k) % ARITY).cast("int").alias(_digit(k)) for k in range(LEVELS)], F.col("digest").alias("_digest"), F.struct(*carried).alias("_inner"),
    )
    rows = rows.repartition("grp", "block")  # one shuffle, which all the groupings below keep
    for level in range(LEVELS):
        above = [_digit(k) for k in range(level + 1, LEVELS)]
        child = F.struct(F.col(_digit(level)).alias("at"), F.col("_digest").alias("digest"), F.col("_inner").alias("inner"))
        rows = rows.groupBy(*keys, *above).agg(F.sort_array(F.collect_list(child)).alias("_kids"))
        joined = F.array_join(F.col("_kids.digest"), "")
        # With a single node left in the group the tree has ended below this level.
        done = F.col("total") <= ARITY**level
        rows = rows.withColumn("_all", joined).select(
            *keys, *above, F.when(done, F.col("_all")).otherwise(F.sha2("_all", 256)).alias("_digest"), F.struct(F.when(~done, F.col("_all")).alias("all"), F.col("_kids").alias("kids")).alias("_inner")
        )
    return rows.select("grp", "block", F.ceil(F.col("total") / block).alias("total"), F.col("_digest").alias("top"), F.col("_inner").alias("children"))


def _leaves(node: Column, level: int, above: Column | None) -> Column:
    """The leaves below ``node`` with the steps of their proofs, lowest level first."""

    def one(child: Column) -> Column:
        start = child["at"] * HEX
        step = F.struct(F.substring(node["all"], F.lit(1), start).alias("left"), F.substring(node["all"], start + HEX + 1, F.length(node["all"])).alias("right"))
        own = F.when(node["all"].isNotNull(), F.array(step)).otherwise(F.array().cast("array<struct<left:string,right:string>>"))
        steps = own if above is None else F.concat(own, above)
        if level == 0:
            return F.array(F.struct(child["digest"].alias("digest"), child["inner"].alias("carried"), steps.alias("proof")))
        return _leaves(child["inner"], level - 1, steps)

    return F.flatten(F.transform(node["kids"], one))


def tree(nodes: DataFrame, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``grp``, ``digest``, the carried columns, ``proof`` and ``top`` of every node) and (``grp``, ``top`` of every group).

    ``nodes`` has grp, rank, total and digest.
    """
    blocks = staged(nested(nodes, carried), "blocks")
    leaf = F.explode(_leaves(F.col("children"), LEVELS - 1, None)).alias("_leaf")
    if blocks.where("total > 1").isEmpty():
        return blocks.select("grp", "top", leaf).select("grp", "_leaf.digest", "_leaf.carried.*", "_leaf.proof", "top"), blocks.select("grp", "top")
    above, tops = tree(blocks.select("grp", F.col("block").alias("rank"), "total", F.col("top").alias("digest"), "block"), ["block"])
    above = above.select(F.col("grp").alias("_g"), F.col("block").alias("_b"), F.col("proof").alias("_above"), F.col("top").alias("_root"))
    met = blocks.join(above, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b")))
    out = met.select("grp", F.col("_root").alias("top"), "_above", leaf)
    return out.select("grp", "_leaf.digest", "_leaf.carried.*", F.concat("_leaf.proof", "_above").alias("proof"), "top"), tops


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, carry: dict[str, Column] | None = None) -> DataFrame:
    """``key``, ``leaf``, the ``carry`` columns, ``subroot``, ``root`` and ``proof`` (array of left and right digests) of every row."""
    carry = carry or {}
    given = [F.col(f"`{f}`") for f in fields]
    leaves = docs.select(
        F.col(f"`{group}`").cast("string").alias("grp"), F.col(f"`{key}`").alias("_key"), leaf_digest(*given).alias("digest"), *[c.alias(f"_c{k}") for k, c in enumerate(carry.values())]
    )
    low, tops = tree(ranked(staged(leaves, "leaves"), ["_key", "digest"]), ["_key", *[f"_c{k}" for k in range(len(carry))]])
    names = tops.select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("name"), F.col("top").alias("digest"))
    high = tree(ranked(names, ["name"]), ["name"])[0].select(F.col("name").alias("_g"), F.col("proof").alias("_above"), F.col("top").alias("root"))
    met = low.join(high, F.col("grp").eqNullSafe(F.col("_g")))
    return met.select(
        F.col("_key").alias(key), F.col("digest").alias("leaf"), *[F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)], F.col("top").alias("subroot"), "root", F.concat("proof", "_above").alias("proof")
    )
