"""SimHash near-dedup with pigeonring filtering.

A document's 64-bit fingerprint has a bit set when more than half of its shingle hashes have it.
Fingerprints that differ in at most ``budget`` bits are linked; documents reachable over links
are one component.

Candidates come from the pigeonring principle. The 64 bits are cut into ``budget + 1`` segments
in a ring. If two fingerprints differ in at most ``budget`` bits, then from some segment on
*every* chain of the next 1, 2, 3, ... segments differs in at most its proportional share of the
budget (``floor(length * budget / segments)`` bits). With segments = budget + 1 the shares are
0, 1, 2, ...: the first segment is equal, the second differs in at most one bit, so one of its
two halves is equal, the third brings at most two, so one of its three thirds is equal. Every
choice of (start, half, third) is one bucket of some 24 equal bits, found by one shuffle of
narrow rows. Inside a bucket, pairs must keep within the share of every longer chain before the
full Hamming check. No bucket is capped: those with more rows than a task should hold are cut
into pieces, and each pair of pieces is a task of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, ship_package, stage
from .graph import components

SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included; 0 without any word."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED)
                  for s, e in zip(starts[:len(words) - shingle + 1].tolist(),
                                  ends[shingle - 1:].tolist())]
    return _majority(np.array(hashes, np.uint64))


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


class Ring:
    """Segments of 64 bits in a ring, and the buckets and chain masks that follow from them."""

    def __init__(self, budget: int):
        self.budget, n = budget, budget + 1
        cuts = [64 * i // n for i in range(n + 1)]
        self.segments = list(zip(cuts, cuts[1:]))
        #: bucket -> (start segment, mask of the bits that must be equal)
        self.buckets = [(s, self._mask(s) | half | third)
                        for s in range(n)
                        for half in self._parts(s + 1, 2) for third in self._parts(s + 2, 3)]

    def _bits(self, segment: int):
        return self.segments[segment % len(self.segments)]

    def _mask(self, segment: int) -> int:
        low, high = self._bits(segment)
        return (1 << high) - (1 << low)

    def _parts(self, segment: int, n: int) -> list[int]:
        low, high = self._bits(segment)
        cuts = [low + (high - low) * i // n for i in range(n + 1)]
        return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]

    def linked(self, bucket: int, diff: np.ndarray) -> np.ndarray:
        """Which differences stay within the share of every chain from the bucket's start, and
        within the budget in full; each longer chain looks only at what the shorter ones left."""
        start, n = self.buckets[bucket][0], len(self.segments)
        left, mask = np.arange(len(diff)), self._mask(start)
        for length in range(2, n + 1):
            mask |= self._mask(start + length - 1)
            share = length * self.budget // n
            left = left[np.bitwise_count(diff[left] & np.uint64(mask)) <= share]
            if not len(left):
                break
        return left


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bucket_rows(prints: DataFrame, ring: Ring) -> DataFrame:
    """One row per fingerprint and bucket: ``bucket, key, fp`` (key: the bits that must match)."""
    rows = F.array(*[F.struct(F.lit(i).alias("bucket"),
                              F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
                     for i, (_, mask) in enumerate(ring.buckets)])
    return prints.select("fp", F.explode(rows).alias("r")).select("r.bucket", "r.key", "fp")


def _tree(ring: Ring, bucket: int, fps: np.ndarray, out: list) -> None:
    """Links that connect what is linked inside one bucket; a spanning tree, never all pairs."""
    rest = np.unique(fps)
    while len(rest) > 1:
        seed, rest, todo = rest[0], rest[1:], [rest[0]]
        while todo and len(rest):
            at = ring.linked(bucket, rest ^ todo.pop())
            if len(at):
                found = rest[at]
                out.append((np.full(len(found), seed), found))
                todo.extend(found)
                keep = np.ones(len(rest), bool)
                keep[at] = False
                rest = rest[keep]


def _runs(batches, keys: list[str]):
    """Batches of rows sorted by ``keys`` -> batches of whole runs of equal keys; a run that
    goes on in the next batch is held back and joined to it (yields columns, is_last_of_run)."""
    held = None
    for batch in batches:
        cols = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
        if held is not None:
            cols = {n: np.concatenate([held[n], v]) for n, v in cols.items()}
        n = len(cols[keys[0]])
        if not n:
            held = cols
            continue
        same = np.ones(n, bool)
        for k in keys:
            same &= cols[k] == cols[k][-1]
        cut = n - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield {c: v[:cut] for c, v in cols.items()}, True
        held = {c: v[cut:] for c, v in cols.items()}
        yield held, False
    if held is not None and len(held[keys[0]]):
        yield held, True


_LINKS = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("piece", pa.int32()),
                    ("a", pa.int64()), ("b", pa.int64())])


def _links_of(ring: Ring, budgeted: int):
    """Sorted ``bucket, key, fp`` rows -> links (piece -1), and the rows of buckets with more
    than ``budgeted`` fingerprints, numbered by piece, for a later step."""
    def batch(bucket, key, piece, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), pa.array(key, pa.int64()), pa.array(piece, pa.int32()),
             pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=_LINKS)

    def inside(cols):
        bucket, key = cols["bucket"], cols["key"]
        fp = cols["fp"].astype(np.int64).view(np.uint64)
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])])
        ends = np.r_[new[1:], len(key)]
        out: list = []
        pairs = new[ends - new == 2]
        for b in np.unique(bucket[pairs]):  # most buckets hold two: all at once
            at = pairs[bucket[pairs] == b]
            ok = at[ring.linked(int(b), fp[at] ^ fp[at + 1])]
            out.append((fp[ok], fp[ok + 1]))
        for s, e in zip(new[ends - new > 2], ends[ends - new > 2]):
            _tree(ring, int(bucket[s]), fp[s:e], out)
        if out:
            a, b = (np.concatenate(x) for x in zip(*out))
            if len(a):
                zero = np.zeros(len(a), np.int32)
                yield batch(zero, np.zeros(len(a), np.int64), zero - 1, a, b)

    def run(batches):
        pieces, wide = 0, None  # of the run that is held back, when it is too wide

        def piece_rows(cols, n, at):
            fp = cols["fp"][at:at + n].astype(np.int64).view(np.uint64)
            return batch(cols["bucket"][at:at + n], cols["key"][at:at + n],
                         np.full(len(fp), pieces, np.int32), fp, np.zeros(len(fp), np.uint64))

        for cols, done in _runs(batches, ["bucket", "key"]):
            if not len(cols["key"]):
                continue
            if wide is not None and done:
                # the run that was cut ends somewhere at the head of these rows
                head = int(np.sum((cols["bucket"] == wide[0]) & (cols["key"] == wide[1])))
                if head:
                    yield piece_rows(cols, head, 0)
                cols = {c: v[head:] for c, v in cols.items()}
                wide, pieces = None, 0
            if done:
                if len(cols["key"]):
                    yield from inside(cols)
                continue
            at = 0
            while len(cols["key"]) - at > budgeted:
                wide = (cols["bucket"][0], cols["key"][0])
                yield piece_rows(cols, budgeted, at)
                pieces, at = pieces + 1, at + budgeted
            if at:
                for c in list(cols):
                    cols[c] = cols[c][at:]

    return run


def _cells_of(ring: Ring):
    """Sorted ``bucket, key, i, j, fp`` rows of pairs of pieces -> links inside each pair."""
    def run(batches):
        for cols, done in _runs(batches, ["bucket", "key", "i", "j"]):
            if not done:
                continue
            fp = cols["fp"].astype(np.int64).view(np.uint64)
            change = np.zeros(len(fp) - 1, bool)
            for k in ("bucket", "key", "i", "j"):
                change |= cols[k][1:] != cols[k][:-1]
            new = np.flatnonzero(np.r_[True, change])
            for s, e in zip(new, np.r_[new[1:], len(fp)]):
                out: list = []
                _tree(ring, int(cols["bucket"][s]), fp[s:e], out)
                for a, b in out:
                    yield pa.RecordBatch.from_pydict(
                        {"a": a.astype(np.uint64).view(np.int64), "b": b.view(np.int64)})

    return run


def similar_links(prints: DataFrame, budget: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """``a, b``: links that connect all fingerprints (column ``fp``, distinct) that differ in at
    most ``budget`` bits, directly or over others. Every linked pair is tested; inside a bucket
    only a spanning tree of the links is returned."""
    ship_package(prints.sparkSession)
    ring = Ring(budget)
    rows = _bucket_rows(prints, ring)
    found = stage(rows.repartition("bucket", "key").sortWithinPartitions("bucket", "key")
                  .mapInArrow(_links_of(ring, bucket_rows),
                              "bucket int, key long, piece int, a long, b long"), "simhash-links")
    links = found.where("piece < 0").select("a", "b")
    wide = found.where("piece >= 0").select("bucket", "key", "piece", F.col("a").alias("fp"))
    pieces = wide.groupBy("bucket", "key").agg((F.max("piece") + 1).alias("n"))
    cells = (wide.join(pieces, ["bucket", "key"])
             .select("bucket", "key", "fp", "piece", F.explode(F.sequence(
                 F.lit(0), F.col("n") - 1)).alias("other"))
             .select("bucket", "key", "fp", F.least("piece", "other").alias("i"),
                     F.greatest("piece", "other").alias("j")))
    more = (cells.repartition("bucket", "key", "i", "j")
            .sortWithinPartitions("bucket", "key", "i", "j")
            .mapInArrow(_cells_of(ring), "a long, b long"))
    return links.unionByName(more)


def near_duplicates(docs: DataFrame, shingle: int = 4, budget: int = 4,
                    bucket_rows: int = 4096, id_col: str = "doc_id", text_col: str = "text"
                    ) -> DataFrame:
    """``doc_id, fingerprint, component_id, group, text_hash`` for every row.

    Null texts and texts without a word have fingerprint zero and are linked like any other.
    Equal fingerprints are one node, however many rows have them. ``component_id`` is the
    smallest non-null id reachable; rows with a null id keep a fingerprint and get the component
    of the rows they are linked to (null if none of these has an id); ``group`` names a
    component by one of its fingerprints. Repeated rows give repeated results; an empty table
    gives an empty result.
    """
    read = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                       F.xxhash64(docs[text_col]).alias("text_hash"))

    def rows(batch):
        prints = np.array([fingerprint(t, shingle) for t in batch["text"]], np.uint64)
        return {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"],
                "fp": prints.view(np.int64)}

    marked = stage(arrow_map(read, rows, "doc_id long, text_hash long, fp long"), "fingerprints")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    groups = stage(components(similar_links(nodes.select("fp"), budget, bucket_rows)),
                   "fingerprint-groups")
    grouped = nodes.join(groups, nodes["fp"] == groups["node"])
    tops = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    moved = grouped.select("fp", "component").join(tops, "component")
    # written first: AQE splits a fingerprint that very many rows have only where both sides of
    # the join are plain shuffles
    labels = stage(nodes.join(moved, "fp", "left").select(
        "fp", F.when(F.col("component").isNull(), F.col("least"))
        .otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("component", "fp").alias("group")), "fingerprint-labels")
    return marked.join(labels, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        "group", "text_hash")


def one_per_group(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """The rows of ``docs`` (``doc_id``, ``text`` and any others) that stay: of each group the
    row with the smallest id (null last), then the smallest text hash; of exact repeats one."""
    none = F.lit(-(1 << 63))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"),
                     F.coalesce("text_hash", none).alias("text_hash"))
    stays = near_duplicates(docs, shingle, budget).groupBy("group").agg(F.min(order).alias("o"))
    stays = stage(stays.select(F.coalesce("o.doc_id", none).alias("_id"),
                               F.col("o.text_hash").alias("_th")), "stays")
    keyed = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), none)).withColumn(
        "_th", F.coalesce(F.xxhash64("text"), none))
    return (keyed.join(stays, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"])
            .select(*docs.columns))
