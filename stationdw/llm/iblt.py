"""Version fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are hashed; each digest is thrown into three cells of a sketch, a cell
holding a count, the xor of its digests and the xor of their checksums. Subtracting the sketches
of two versions cancels what they share. A cell with one digest left (count of 1 or -1 and a
fitting checksum) gives that digest away; taking it out of its other cells frees more, until the
sketch is empty: then every differing digest is known. If cells stay, the sketch was too small,
and the pair is tried again with twice as many cells.

All of it is DataFrame expressions: cells are rows, sketches are grouped sums and xors, a round
of peeling is an explode and two aggregates. Rows of a document stay in its partition, so that
rounds need no shuffle, and time is in proportion to the number of paragraphs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, stage

BASE_CELLS = 24      # a multiple of 3; also the size of the printed fingerprint
ROUNDS = 4           # of peeling before a sketch counts as too small
#: A paragraph is a line; of a longer one, pieces up to the first sentence end after 200
#: characters (or 400 characters) count as paragraphs.
PARAGRAPH = r"[^\n]{1,200}(?:[^\n.!?]{0,199}[.!?]?)"
_NULL_KEY = -(1 << 63)  # stands for a null id: the smallest, as nulls sort first


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), 0),
                                        lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(F.lit("check"), key)


def _cell(key: Column, j: int, cells: Column | int) -> Column:
    """The j-th cell of a digest: one in each third of the sketch."""
    third = (cells / 3).cast("int") if isinstance(cells, Column) else F.lit(cells // 3)
    return (F.pmod(F.xxhash64(F.lit(j), key), third.cast("long"))
            + F.lit(j).cast("long") * third).cast("long")


def fingerprints(texts: DataFrame, cells: int = BASE_CELLS) -> DataFrame:
    """``texts`` (row, version, keys: a digest array) -> ``row, version, printed``: the sketch in
    print, base 64 of every filled cell in order: its number (8 bits), count (8), digest xor
    (64) and checksum xor (32). Texts without a paragraph have no row."""
    hits = (texts.select("row", "version", F.explode("keys").alias("key"))
            .withColumn("check", _check(F.col("key")))
            .select("row", "version", "key", "check", F.explode(F.array(*[
                _cell(F.col("key"), j, cells) for j in range(3)])).alias("cell")))
    sums = hits.groupBy("row", "version", "cell").agg(
        F.count("*").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    last = lambda column, n: F.right(F.lpad(F.hex(column), 16, "0"), F.lit(n))
    printed = sums.select("row", "version", F.concat(
        last("cell", 2), last("n", 2), last("key", 16), last("check", 8)).alias("cell"))
    return printed.groupBy("row", "version").agg(F.translate(F.base64(F.unhex(F.array_join(
        F.sort_array(F.collect_list("cell")), ""))), "\r\n", "").alias("printed"))


def _peel(pairs: DataFrame, rounds: int, recover: bool) -> DataFrame:
    """``pairs`` (pair, cells, a, b; partitioned by pair) -> rows of ``pair, cells, found, slot,
    n``: open cells (found 0), and what was recovered (found 1): by digest (``slot``, with n 1
    for a and -1 for b) if ``recover``, else counted in slot 1 (a) and -1 (b). Pairs without a
    difference have no row."""
    by, zero = ["pair", "cells", "found", "slot"], F.lit(0).cast("long")
    rows = pairs.select("pair", "cells", F.size("a").alias("n_a"),
                        F.posexplode(F.concat("a", "b")).alias("at", "key"))
    rows = rows.withColumn("n", F.when(F.col("at") < F.col("n_a"), 1).otherwise(-1).cast("long"))
    rows = rows.withColumn("check", _check(F.col("key"))).select(
        "pair", "cells", F.lit(0).alias("found"), F.explode(F.array(*[
            _cell(F.col("key"), j, F.col("cells")) for j in range(3)])).alias("slot"),
        "n", "key", "check")
    filled = (F.col("found") == 1) | (F.col("n") != 0) | (F.col("key") != 0) | (
        F.col("check") != 0)
    sums = (F.sum("n").alias("n"), F.bit_xor("key").alias("key"),
            F.bit_xor("check").alias("check"))

    def row(found, slot, n, key="key", check="check"):
        value = lambda x: F.col(x) if isinstance(x, str) else x
        return F.struct(F.lit(found).alias("found") if isinstance(found, int)
                        else found.alias("found"), slot.alias("slot"), n.alias("n"),
                        value(key).alias("key"), value(check).alias("check"))

    cells = rows.groupBy(*by).agg(*sums).where(filled)
    same = row(F.col("found"), F.col("slot"), F.col("n"))
    for _ in range(rounds):
        pure = ((F.col("found") == 0) & (F.abs("n") == 1)
                & (F.col("check") == _check(F.col("key"))))
        # a digest may show in up to three cells at once: shown digests (found 2) are grouped
        shown = (cells.select("pair", "cells", F.explode(F.when(
            pure, F.array(same, row(2, F.col("key"), F.col("n")))).otherwise(F.array(same)))
            .alias("r")).select("pair", "cells", "r.*").groupBy(*by)
            .agg(*[F.max(c).alias(c) for c in ("n", "key", "check")]))
        kept = (row(1, F.col("key"), F.col("n")) if recover
                else row(1, F.col("n"), F.lit(1).cast("long"), zero, zero))
        taken = [row(0, _cell(F.col("key"), j, F.col("cells")), -F.col("n")) for j in range(3)]
        cells = (shown.select("pair", "cells", F.explode(F.when(
            F.col("found") == 2, F.array(kept, *taken)).otherwise(F.array(same)))
            .alias("r")).select("pair", "cells", "r.*").groupBy(*by).agg(*sums).where(filled))
    return cells.select(*by, "n")


def differences(pairs: DataFrame, rounds: int = ROUNDS, recover: bool = False) -> DataFrame:
    """The difference of each pair's digest arrays a and b (``pairs``: pair, a, b).

    ``recover``: ``pair, digest, side`` (1: only in a, -1: only in b), a row per digest that
    differs. Otherwise ``pair, only_a, only_b``, a row per pair that differs. A sketch starts
    with room for 3/2 of all digests of its pair, which empties when all differ, as a rule; what
    does not empty goes on with twice the cells until none is left.
    """
    room = (F.size("a") + F.size("b")) * 1.5 / BASE_CELLS
    first = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(room, F.lit(1.0))))) * BASE_CELLS
    todo, done = pairs.withColumn("cells", first.cast("int")), None
    while True:
        got = stage(_peel(todo.repartition("pair"), rounds, recover), "peeled")
        failed = stage(got.where("found = 0").select("pair", "cells").distinct(), "unpeeled")
        good = got.where("found = 1").join(failed, "pair", "left_anti")
        done = good if done is None else done.unionByName(good)
        if failed.isEmpty():
            break
        todo = pairs.join(failed, "pair").withColumn("cells", (F.col("cells") * 2).cast("int"))
    if recover:
        return done.select("pair", F.col("slot").alias("digest"),
                           F.col("n").cast("int").alias("side"))
    return done.groupBy("pair").agg(
        F.sum(F.when(F.col("slot") == 1, F.col("n")).otherwise(0)).alias("only_a"),
        F.sum(F.when(F.col("slot") == -1, F.col("n")).otherwise(0)).alias("only_b"))


def _likeness(differing: Column, size_a: Column, size_b: Column) -> Column:
    """Shared digests out of all of both texts, each counted twice; 1 for two empty texts."""
    return F.when(size_a + size_b == 0, F.lit(1.0)).otherwise(
        1.0 - F.coalesce(differing, F.lit(0)) / (size_a + size_b))


def _previous(known: DataFrame) -> DataFrame:
    """``k, th, pk, pth, pn``: for each text (key and hash) the one before it in key order, the
    last one for the first. Ranges of keys are sorted each by itself; a row per range joins them.
    """
    ranged = stage(known.repartitionByRange("k", "th").withColumn(
        "range", F.spark_partition_id()), "key-ranges")
    here = F.struct("k", "th", "n")
    inner = F.lag(here).over(Window.partitionBy("range").orderBy("k", "th"))
    ends = ranged.groupBy("range").agg(F.max(here).alias("end"))
    by_range = Window.orderBy("range")  # one row per partition of the table
    ends = ends.select("range", F.coalesce(
        F.lag("end").over(by_range),
        F.last("end").over(by_range.rowsBetween(Window.unboundedPreceding,
                                                Window.unboundedFollowing))).alias("before"))
    return (ranged.withColumn("p", inner).join(ends, "range")
            .withColumn("p", F.coalesce("p", "before"))
            .select("k", "th", F.col("p.k").alias("pk"), F.col("p.th").alias("pth"),
                    F.col("p.n").alias("pn")))


def version_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
                         ) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`` for every row.

    The edited text is the text with its last floor(n / 2) code points replaced by the first as
    many (or all) of the next document. Likeness is 1 minus the share of differing paragraph
    digests among those of both texts. A null text is empty; ids ascend with null first; rows
    with the same id follow each other by text hash; exactly repeated rows are one document to
    their neighbours and get equal results; a single document is its own next.
    """
    read = columns_of(docs, doc_id=id_col, text=text_col)
    read = read.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_KEY)).alias("k"),
                       F.coalesce("text", F.lit("")).alias("text"))
    read = read.withColumn("th", F.xxhash64("text"))
    known = read.select("k", "th", F.char_length("text").alias("n")).distinct()
    before = stage(_previous(known), "previous")
    half = F.expr("n div 2").cast("int")
    offered = (read.join(before, ["k", "th"])
               .select(F.col("pk").alias("k"), F.col("pth").alias("th"),
                       F.col("text").substr(F.lit(1), F.expr("cast(pn div 2 as int)"))
                       .alias("given"), digests(F.col("text")).alias("next_keys"))
               .dropDuplicates(["k", "th"]))
    joined = read.join(offered, ["k", "th"]).withColumn("n", F.char_length("text"))
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n") - half), F.col("given"))
    facts = joined.select(
        "k", "th", F.col("n").cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"), digests(F.col("text")).alias("own"),
        digests(edited).alias("new"), "next_keys")
    facts = stage(facts.withColumn("row", F.monotonically_increasing_id()), "versions")
    pairs = facts.select(F.col("own").alias("a"), F.explode(F.array(
        F.struct((F.col("row") * 2).alias("pair"), F.col("new").alias("b")),
        F.struct((F.col("row") * 2 + 1).alias("pair"), F.col("next_keys").alias("b")))).alias("p")
    ).select("p.pair", "a", "p.b")
    differing = F.col("only_a") + F.col("only_b")
    found = (differences(pairs).groupBy(F.shiftright("pair", 1).alias("row")).agg(
        F.sum(F.when(F.col("pair") % 2 == 0, differing)).alias("d_edited"),
        F.sum(F.when(F.col("pair") % 2 == 1, differing)).alias("d_next")))
    texts = facts.select("row", F.explode(F.array(
        F.struct(F.lit(0).alias("version"), F.col("own").alias("keys")),
        F.struct(F.lit(1).alias("version"), F.col("new").alias("keys")))).alias("t"))
    prints = fingerprints(texts.select("row", "t.*").repartition("row")).groupBy("row").agg(
        *[F.max(F.when(F.col("version") == v, F.col("printed"))).alias(name)
          for v, name in ((0, "fingerprint"), (1, "edited_fingerprint"))])
    return facts.join(found, "row", "left").join(prints, "row", "left").select(
        F.expr(f"nullif(k, {_NULL_KEY + 1} - 1)").alias("doc_id"), "n_chars", "edited_sha256",
        F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        _likeness(F.col("d_edited"), F.size("own"), F.size("new")).alias("near_edited"),
        _likeness(F.col("d_next"), F.size("own"), F.size("next_keys")).alias("near_next"))
