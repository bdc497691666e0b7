"""Prefix trie over conversations by fixed-length block hashing.

A node of the trie is a distinct sequence of a conversation's first turns. Conversations are cut
into blocks of a fixed number of turns and grouped by the digests of their successive blocks
first, so that a shared beginning costs one row a block. Turn boundaries are refined only inside
blocks where siblings diverge: where all conversations that share what goes before also share the
whole block, its inner nodes have the same members as its end, and behind the block where a
conversation is left alone its nodes are its own; neither is grouped.

A digest of the first d turns is the bitwise exclusive or of two 64-bit hashes of (place, turn),
so that digests of blocks combine by running windows and no conversation is ever collected. Texts
are read once, for their digest and length, and are never shuffled. Windows run over one
conversation's rows of some 60 bytes a turn; groups that many conversations share are partial
aggregates joined back, which AQE splits where one of them is hot.

A node is known by its smallest member and its depth, so a conversation's nodes form a chain that
hangs below a node of a smaller conversation. Sums over subtrees run along a chain by a window,
and over chains that hang on chains by pointer doubling, in as many rounds as the logarithm of
how deep chains hang on each other.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

_ENDS = "q long, e long, first long, ids string"
_HASHED = "q long, e long, ends_sha256 string"
#: Ids that are joined to one text before they are hashed.
_IDS = 4096


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
          role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``c, p, key, n_bytes`` of every turn: the conversation, the turn's place in it from 0, a
    digest of role and text, and the bytes of the text.

    Turns are ordered by ``turn``, null first, ties by role and then by digest; repeated rows are
    turns of their own. Null roles and texts are empty ones. Rows without a conversation are left
    out; other columns are not read.
    """
    text = F.coalesce(conversations[text_col].cast("string"), F.lit(""))
    role = F.coalesce(conversations[role_col].cast("string"), F.lit(""))
    read = conversations.select(
        conversations[conv_col].cast("long").alias("c"), conversations[turn_col].alias("turn"),
        role.alias("role"),
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes")).where("c IS NOT NULL")
    place = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    return read.select("c", (F.row_number().over(place) - 1).cast("long").alias("p"), "key",
                       "n_bytes")


def shared_beginnings(own: DataFrame, family: int = 5, longest: int = 9
                      ) -> tuple[DataFrame, DataFrame]:
    """Conversations of a family given the beginning of its first one, as when a dialogue is
    taken up again from a saved state: the first h turns of conversation c - c % family, then
    c's own turns after its first h, with h = crc32(decimal c) % longest.

    Returns turns as ``turns`` does, and ``c, length`` of every conversation (0 included).
    """
    own = stage(own, "own-turns")
    lengths = own.groupBy("c").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % longest
    first = lengths.select(F.col("c").alias("first"), F.col("n").alias("first_n"))
    convs = lengths.withColumn("h", h).withColumn("first", F.col("c") - F.col("c") % family)
    convs = convs.join(first, "first", "left").select(
        "c", "first", "h", F.least("h", F.coalesce("first_n", F.lit(0))).alias("taken"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("kept"))
    convs = stage(convs, "rebuilt-lengths")
    begins = (own.where(F.col("p") < longest - 1).withColumnRenamed("c", "first")
              .join(convs.select("c", "first", "h"), "first").where("p < h")
              .select("c", "p", "key", "n_bytes"))
    rest = (own.where(F.col("p") >= h).join(convs.select("c", "h", "taken"), "c")
            .select("c", (F.col("taken") + F.col("p") - F.col("h")).alias("p"), "key", "n_bytes"))
    return (stage(begins.unionByName(rest), "rebuilt-turns"),
            convs.select("c", (F.col("taken") + F.col("kept")).alias("length")))


def _members(rows: DataFrame, n_all: int, block: int) -> DataFrame:
    """``c, d, n_bytes, n, rep`` for every turn of every conversation: how many conversations
    share the first d turns, and the smallest of them."""
    rows = rows.withColumn("k", F.expr(f"p div {block}")).withColumn(
        "x1", F.xxhash64("p", "key")).withColumn("x2", F.xxhash64(F.lit(1), "key", "p"))
    upto = Window.partitionBy("c").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    # blocks, by the digest of all turns up to their end
    blocks = stage(rows.groupBy("c", "k").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.count("*").alias("turns"))
        .select("c", "k", "turns", F.bit_xor("x1").over(upto).alias("x1"),
                F.bit_xor("x2").over(upto).alias("x2")), "turn-blocks")
    shared = stage(blocks.where(F.col("turns") == block).groupBy("k", "x1", "x2").agg(
        F.count("*").alias("n_end"), F.min("c").alias("rep")).where("n_end > 1"), "shared-blocks")
    before = Window.partitionBy("c").orderBy("k")
    seen = blocks.join(shared, ["k", "x1", "x2"], "left").select(
        "c", "k", "x1", "x2", F.coalesce("n_end", F.lit(1)).alias("n_end"),
        F.coalesce("rep", "c").alias("rep"))
    seen = seen.select("c", "k", "n_end", "rep",
                       F.lag("n_end", 1, n_all).over(before).alias("n_start"),
                       F.lag("x1", 1, 0).over(before).alias("x1_start"),
                       F.lag("x2", 1, 0).over(before).alias("x2_start"))
    seen = seen.withColumn("diverges", (F.col("n_start") > 1) & (F.col("n_end") < F.col("n_start")))
    inside = Window.partitionBy("c", "k").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    marked = stage(rows.join(seen, ["c", "k"]).select(
        "c", (F.col("p") + 1).alias("d"), "n_bytes", "diverges", F.col("n_end").alias("n"), "rep",
        F.col("x1_start").bitwiseXOR(F.bit_xor("x1").over(inside)).alias("x1"),
        F.col("x2_start").bitwiseXOR(F.bit_xor("x2").over(inside)).alias("x2")), "marked-turns")
    # turn by turn only where siblings diverge
    refine = marked.where("diverges").drop("n", "rep")
    groups = stage(refine.groupBy("d", "x1", "x2").agg(
        F.count("*").alias("n"), F.min("c").alias("rep")).where("n > 1"), "diverging-turns")
    refined = refine.join(groups, ["d", "x1", "x2"], "left").select(
        "c", "d", "n_bytes", F.coalesce("n", F.lit(1)).alias("n"),
        F.coalesce("rep", "c").alias("rep"))
    return refined.unionByName(marked.where("NOT diverges").select("c", "d", "n_bytes", "n",
                                                                  "rep"))


def _chain_sums(chains: DataFrame) -> DataFrame:
    """``c, leaves, saved`` summed over a chain and all chains below it, from ``c, q`` (the chain
    it hangs on, or null), ``leaves`` and ``saved`` of the chain alone."""
    now = stage(chains, "chain-sums")
    while not now.where("q IS NOT NULL").isEmpty():
        # q is the chain 2^i above; sums reach 2^i chains down
        below = now.where("q IS NOT NULL").groupBy(F.col("q").alias("c")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = now.select(F.col("c").alias("q"), F.col("q").alias("next"))
        moved = stage(now.join(above, "q", "left").select("c", "leaves", "saved", "next"),
                      "chain-pointers")
        now = stage(moved.join(below, "c", "left").select(
            "c", F.col("next").alias("q"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "chain-sums")
    return now.select("c", "leaves", "saved")


def _runs(batches):
    """Rows sorted by (q, e, c), as (q, e, first c, ids joined) of up to ``_IDS`` ids."""
    node, ids = None, []
    for batch in batches:
        rows = batch.to_pydict()
        out: list[tuple] = []
        for q, e, c in zip(rows["q"], rows["e"], rows["c"]):
            if (q, e) != node or len(ids) == _IDS:
                if ids:
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                node, ids = (q, e), []
            ids.append(c)
        yield from _batch(out, ("q", "e", "first", "ids"))
    yield from _batch([(*node, ids[0], ",".join(map(str, ids)))] if ids else [],
                      ("q", "e", "first", "ids"))


def _hashed(batches):
    """Runs sorted by (q, e, first), as (q, e, SHA-256 of all its ids)."""
    node, digest = None, None
    for batch in batches:
        rows = batch.to_pydict()
        out = []
        for q, e, ids in zip(rows["q"], rows["e"], rows["ids"]):
            if (q, e) != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (q, e), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield from _batch(out, ("q", "e", "ends_sha256"))
    yield from _batch([(*node, digest.hexdigest())] if node else [], ("q", "e", "ends_sha256"))


def _batch(rows: list[tuple], names: tuple):
    if rows:
        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``q, e, ends_sha256`` for every node (q, e) at whose depth a conversation c ends.

    A hash runs over a node's ids in order. Ids of a node that very many share are first joined
    to texts in all tasks, over ranges of (node, id); one task then hashes these few rows as a
    stream, so that no node's ids are ever held together.
    """
    node = ["q", "e"]
    sizes = stage(ends.groupBy(*node).agg(F.count("*").alias("n"), F.min("c").alias("c")),
                  "end-counts")
    alone = sizes.where("n = 1").select(*node, F.sha2(F.col("c").cast("string"), 256).alias(
        "ends_sha256"))
    many = ends.join(sizes.where("n > 1").select(*node), node)
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = stage(many.select(*node, "c").repartitionByRange(parts, *node, "c")
                 .sortWithinPartitions(*node, "c").mapInArrow(_runs, _ENDS), "end-runs")
    return alone.unionByName(runs.repartition(parts, *node).sortWithinPartitions(*node, "first")
                             .mapInArrow(_hashed, _HASHED))


def prefix_trie(rows: DataFrame, convs: DataFrame, block: int = 4) -> DataFrame:
    """The trie's nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``rows`` are turns as ``turns`` gives them (places from 0 without gaps), ``convs`` has
    ``c, length`` of all conversations, each once. A conversation without turns ends at the root.
    Without any conversation there is no node. Results do not depend on ``block``.
    """
    all_convs = convs.agg(F.count("*").alias("n"), F.min("c").alias("least")).first()
    n_all, top = all_convs["n"], all_convs["least"] if all_convs["n"] else 0
    along = Window.partitionBy("c").orderBy("d")
    members = stage(_members(rows, n_all, block).select(
        "c", "d", "n_bytes", "n", "rep", F.lag("rep", 1, top).over(along).alias("parent"),
        F.lead("d").over(along).isNull().alias("last")), "members")
    nodes = members.where("rep = c").select(
        "c", "d", "n", "parent", "last", ((F.col("n") - 1) * F.col("n_bytes")).alias("saved"))
    root = convs.where(F.col("c") == top).select(
        "c", F.lit(0).cast("long").alias("d"), F.lit(n_all).cast("long").alias("n"),
        F.lit(None).cast("long").alias("parent"), (F.col("length") == 0).alias("last"),
        F.lit(0).cast("long").alias("saved"))
    nodes = stage(nodes.unionByName(root), "nodes")
    heads = stage(nodes.where("parent <> c").select(
        "c", F.col("parent").alias("q"), (F.col("d") - 1).alias("e")), "chain-heads")
    hanging = heads.groupBy(F.col("q").alias("c"), F.col("e").alias("d")).agg(
        F.count("*").alias("below"))
    tips = nodes.where("last").select("c", "d").join(hanging, ["c", "d"], "left").select(
        "c", F.when(F.col("below").isNull(), 1).otherwise(0).cast("long").alias("leaf"))
    chains = (nodes.groupBy("c").agg(F.sum("saved").alias("saved"))
              .join(tips, "c").join(heads.select("c", "q"), "c", "left")
              .select("c", "q", F.col("leaf").alias("leaves"), "saved"))
    sums = _chain_sums(chains)
    hung = heads.join(sums, "c").groupBy(F.col("q").alias("c"), F.col("e").alias("d")).agg(
        F.count("*").alias("below"), F.sum("leaves").alias("below_leaves"),
        F.sum("saved").alias("below_saved"))
    ends = members.where("last").select("c", F.col("rep").alias("q"), F.col("d").alias("e")) \
        .unionByName(convs.where("length = 0").select(
            "c", F.lit(top).cast("long").alias("q"), F.lit(0).cast("long").alias("e")))
    hashes = _end_hashes(stage(ends, "ends")).select(
        F.col("q").alias("c"), F.col("e").alias("d"), "ends_sha256")
    down = Window.partitionBy("c").orderBy(F.col("d").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    zero = F.lit(0)
    return (nodes.join(hung, ["c", "d"], "left").join(hashes, ["c", "d"], "left").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"),
        F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.coalesce("below", zero) + F.when(F.col("last"), 0).otherwise(1)).alias("n_children"),
        # the chain's own tip is a leaf if nothing hangs there
        F.sum(F.coalesce("below_leaves", zero) + F.when(
            F.col("last") & F.col("below").isNull(), 1).otherwise(0)).over(down).alias("n_leaves"),
        F.sum(F.col("saved") + F.coalesce("below_saved", zero)).over(down).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
