"""Substring dedup with difference-cover anchors.

A difference cover of a period v is a set D of residues such that for any two positions i, j
there is a shift below v that brings both onto D (modulo v). So if two texts share a passage of
``window`` words, some shift below v brings both of its places onto cover positions, and the
``window - v + 1`` words from there lie inside the passage: hashing those anchors only (|D| of
every v positions) is enough to meet every long match in at least one equal anchor.

Steps, each a Spark job over narrow rows:

1. hash the anchors of every text; keep the hashes that stand in different texts;
2. extend: around each such anchor, hash the full windows that contain it (two independent
   64-bit hashes) - only these can be repeated - and take the least id of each window;
3. a window that starts in a document with a smaller id marks its words; each text drops the
   marked words.

Documents with equal texts are one text here (under its least id), so groups of copies of any
size cost one text and never meet in one group.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, pieces, ship_package, stage

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so invertible modulo 2**64


@lru_cache(maxsize=8)
def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest difference cover of ``period`` that starts with 0, by iterative deepening
    (periods q*q + q + 1 for prime powers q have perfect ones, e.g. 5 residues for 21)."""
    def search(chosen, seen, size):
        if len(seen) == period:
            return tuple(chosen)
        room = size - len(chosen)
        if not room or len(seen) + room * (2 * len(chosen) + room - 1) < period:
            return None
        for x in range(chosen[-1] + 1, period):
            new = seen | {(x - c) % period for c in chosen} | {(c - x) % period for c in chosen}
            if (got := search([*chosen, x], new, size)) is not None:
                return got
        return None

    for size in range(1, period + 1):
        if (got := search([0], {0}, size)) is not None:
            return got
    raise ValueError(period)


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space and the five ASCII white-space controls."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    def cumulative(factor):
        steps = np.full(n, factor, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return cumulative(np.uint64(base)), cumulative(np.uint64(pow(base, -1, 1 << 64)))


def window_hashes(words: list[bytes], length: int, base: int, at: np.ndarray | None = None
                  ) -> np.ndarray:
    """Polynomial hashes of the ``length``-word windows at all, or at the given, positions."""
    digest = xxhash.xxh64_intdigest
    codes = np.fromiter(map(digest, words), np.uint64, len(words))
    return _windows(codes, length, base, at)


def _windows(codes, length, base, at=None):
    n = len(codes)
    if n < length:
        return np.empty(0, np.uint64)
    up, down = _powers(base, 1 << max(10, (n - 1).bit_length()))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * down[:n], dtype=np.uint64)))
    at = np.arange(n - length + 1) if at is None else at
    h = (total[at + length] - total[at]) * up[at]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_BASES[1])
    return h ^ (h >> np.uint64(29))


def _texts(docs: DataFrame) -> DataFrame:
    """Documents with two independent hashes of their text (together its identity)."""
    return (docs.where(F.col("text").isNotNull())
            .withColumn("th", F.xxhash64("text"))
            .withColumn("th2", F.xxhash64(F.lit("second"), "text")))


def _anchor_map(window: int, period: int):
    cover = np.array(difference_cover(period))
    length = window - period + 1
    out = pa.schema([("h", pa.int64()), ("th", pa.int64()), ("pos", pa.int32())])

    def run(batches):
        for batch in pieces(batches):
            hashes, keys, places = [], [], []
            for text, th in zip(batch.column("text").to_pylist(),
                                batch.column("th").to_pylist()):
                words = words_of(text)
                if len(words) < window:
                    continue
                last = len(words) - length
                at = (np.arange(0, last + 1, period)[:, None] + cover).ravel()
                at = at[at <= last]
                hashes.append(window_hashes(words, length, _BASES[0], at))
                keys.append(np.full(len(at), th))
                places.append(at)
            if hashes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes).view(np.int64)),
                     pa.array(np.concatenate(keys)),
                     pa.array(np.concatenate(places).astype(np.int32))], schema=out)

    return run


def _spread(places, before: int, after: int, n: int) -> np.ndarray:
    """Marks on n positions: [p - before, p + after] of every place p that is in range."""
    edges = np.zeros(n + 1, np.int32)
    p = np.asarray(places, np.int64)
    p = p[p - before < n]
    np.add.at(edges, np.maximum(p - before, 0), 1)
    np.add.at(edges, np.minimum(p + after + 1, n), -1)
    return np.cumsum(edges[:-1]) > 0


def _window_map(window: int, period: int):
    out = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("least", pa.int64()),
                     ("th", pa.int64()), ("pos", pa.int32())])

    def run(batches):
        for batch in pieces(batches):
            for row in batch.to_pylist():
                codes = np.fromiter(map(xxhash.xxh64_intdigest, words_of(row["text"])), np.uint64)
                n = len(codes) - window + 1
                if n < 1:
                    continue
                at = np.flatnonzero(_spread(row["places"], period - 1, 0, n))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_windows(codes, window, b, at).view(np.int64)) for b in _BASES]
                        + [pa.array(np.full(len(at), row[c])) for c in ("least", "th")]
                        + [pa.array(at.astype(np.int32))], schema=out)

    return run


def repeated_windows(docs: DataFrame, window: int = 50, period: int = 21) -> DataFrame:
    """``th, pos``: windows (text hash, first word) that also start in a document with an id
    smaller than every id of the text. ``docs`` has ``doc_id, text, th, th2``."""
    if not 0 < period <= window:
        raise ValueError("the period must not exceed the window")
    ship_package(docs.sparkSession)
    texts = docs.select("text", "th")
    anchors = stage(texts.mapInArrow(_anchor_map(window, period), "h long, th long, pos int"),
                    "anchors")
    shared = stage(anchors.groupBy("h").agg(F.min("th").alias("lo"), F.max("th").alias("hi"))
                   .where("lo < hi").select("h"), "shared-anchors")
    places = (anchors.join(shared, "h", "left_semi").groupBy("th")
              .agg(F.collect_set("pos").alias("places")))
    # one document stands for all with the same text
    least = docs.groupBy("th", "th2").agg(F.min("doc_id").alias("least"))
    chosen = places.join(least, "th").select("th", "th2", "least", "places")
    candidates = (docs.select("text", "doc_id", "th", "th2").join(chosen, ["th", "th2"])
                  .where("doc_id = least").select("text", "least", "th", "places")
                  .mapInArrow(_window_map(window, period),
                              "w1 long, w2 long, least long, th long, pos int"))
    windows = stage(candidates, "windows")
    # written, so that the join's sides are plain shuffles: AQE can then split a window that
    # very many texts share, which it does not below an aggregation
    first = stage(windows.groupBy("w1", "w2").agg(
        F.min("least").alias("first"), F.max("least").alias("last"))
        .where("first < last").drop("last"), "first-windows")
    return windows.join(first, ["w1", "w2"]).where("first < least").select("th", "pos")


def dedup_substrings(docs: DataFrame, window: int = 50, period: int = 21,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row.

    A word goes if a window of ``window`` words that covers it also starts in a document with a
    smaller id; windows are judged on the input. Null texts and texts shorter than the window
    lose nothing. Rows with a null id lose nothing and take nothing from others. Rows with the
    same id never take from each other, so exact repeats get the same result.
    """
    read = columns_of(docs, doc_id=id_col, text=text_col)
    known = _texts(read.where(F.col("doc_id").isNotNull()).withColumn(
        "doc_id", F.col("doc_id").cast("long")))
    marks = (repeated_windows(known, window, period).groupBy("th")
             .agg(F.collect_set("pos").alias("marks")))
    least = known.groupBy("th", "th2").agg(F.min("doc_id").alias("least"))
    facts = stage(least.join(marks, "th", "left"), "window-marks")
    # rows without an id or a text have nothing to look up
    plain = read.where(F.col("doc_id").isNull() | F.col("text").isNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.lit(None).cast("long").alias("least"), F.lit(None).cast("array<int>").alias("marks"))
    both = (known.join(facts, ["th", "th2"]).select("doc_id", "text", "least", "marks")
            .unionByName(plain))
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_text", pa.string())])

    def run(batches):
        for batch in pieces(batches):
            got: dict[str, list] = {n: [] for n in out.names}
            for row in batch.to_pylist():
                words = words_of(row["text"])
                n, kept = len(words), words
                if row["least"] is not None and n >= window:
                    if row["least"] < row["doc_id"]:
                        kept = []  # every window starts in the copy with the least id
                    elif row["marks"]:
                        gone = _spread(row["marks"], 0, window - 1, n)
                        kept = [w for w, x in zip(words, gone.tolist()) if not x]
                got["doc_id"].append(row["doc_id"])
                got["n_words"].append(n)
                got["n_removed"].append(n - len(kept))
                got["kept_text"].append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_pydict(got, schema=out)

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
