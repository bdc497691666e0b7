"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide link counts.

Tokenizer A is a byte-level BPE, B a piece model with byte fallback. Every text is encoded by
both; the byte offsets where tokens of both end cut it into groups, and an A token and a B token
are linked where their bytes overlap. Two vocabularies share most of their frequent strings, so
almost every group of ordinary prose is one A token beside the one B token of the same bytes:

* an array made once from the two vocabularies gives the B id of the same bytes for every A id;
  groups that agree with it are counted in one vector of vocabulary length a task and never
  shuffled as pairs;
* only links of the other, irregular groups are counted as pairs, summed per block of texts
  before the shuffle.

Totals go back to the texts through the blocks: a block asks once for each of its distinct pairs
(not once for each text or link), gets one row of answers, and adds them up for its texts. What
is sent to every task has a length fixed by the vocabularies.

Texts are cut where both tokenizers certainly cut (a single space or line break between two
signs that are no white space), so that a stretch met again is not encoded again.

A's stretches of Latin letters go through the faster of two installed libraries. It joins any
neighbours whose union is a token, lowest id first, while the file names one pair for every
token. Both do the same if ids follow the merges' order and every token's own bytes come back as
that one token (a union's bytes are then always met in its named halves); this is proven for the
whole vocabulary when it is loaded, and otherwise the file's own library does all stretches.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from .common import (columns_of, keeps_tables, only_tables_of, pieces, ship_package,
                     small_batches, stage)

SPACE = "▁"  # how the piece model writes a space
#: In front of a single space or line break that stands between signs that are no white space.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Signs above Latin: what counts as a letter there differs between versions of Unicode.
_BEYOND_LATIN = re.compile("[\u0250-\U0010ffff]")

_BLOCK = ("block long, doc_id array<long>, n_a array<int>, n_b array<int>, n_groups array<int>, "
          "n_links array<int>, groups_sha256 array<string>, "
          # irregular links of each text: places in the block's list of pairs, and how often
          "link_ends array<int>, links array<int>, link_times array<int>, "
          # regular groups of each text: A ids, and how often
          "same_ends array<int>, same array<int>, same_times array<int>, "
          "pairs array<int>, pair_times array<long>")
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
           "count_sum long, groups_sha256 string")


class Pair:
    """Both tokenizers and what is known of their vocabularies."""

    def __init__(self, path_a: str, path_b: str, cache_bytes: int = 150 << 20):
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec["normalizer"] is not None or spec["model"]["type"] != "BPE"
                or spec["pre_tokenizer"]["type"] != "ByteLevel"
                or spec["pre_tokenizer"]["add_prefix_space"]):
            raise ValueError("A is not a plain byte-level BPE file")
        self.a = Tokenizer.from_file(path_a)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        vocab = self.a.get_vocab(with_added_tokens=True)
        special = {t["content"] for t in spec["added_tokens"]}
        self.size_a, self.size_b = max(vocab.values()) + 1, self.b.vocab_size()
        if self.size_a * self.size_b >= 1 << 31:
            raise ValueError("a pair of ids has to fit 31 bits")
        if not set(_byte_signs()) <= vocab.keys():
            raise ValueError("A has no token for some byte")
        byte_of = {c: n for n, c in enumerate(_byte_signs())}
        self.bytes_a = [b""] * self.size_a
        for token, i in vocab.items():
            self.bytes_a[i] = token.encode() if token in special else bytes(
                byte_of[c] for c in token)
        self.bytes_b = []
        for i in range(self.size_b):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace(SPACE, " ").encode())
        plain = [self.b.id_to_piece(i) for i in range(self.size_b)
                 if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in plain):
            raise ValueError("a piece reaches across a space or a line break")
        lead = self.b.encode("\n")
        if len(lead) != 2 or self.bytes_b[lead[0]] != b" ":
            raise ValueError("B has to put one space in front of a text")
        id_of = {}
        for i in range(self.size_b):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                # a whole piece goes before a byte of the same value
                if self.bytes_b[i] not in id_of or not self.b.is_byte(i):
                    id_of[self.bytes_b[i]] = i
        #: The B id of the same bytes for every A id, -1 where there is none.
        self.same = np.array([id_of.get(x, -1) if x else -1 for x in self.bytes_a], np.int32)
        self._len_a = np.array(list(map(len, self.bytes_a)))
        self._len_b = np.array(list(map(len, self.bytes_b)))
        self._fast = self._proven(spec["model"], special)
        # an id of A, the last of A in its group, an id of B, the last of B in its group
        self._text = [f"{i}{end}" for n, end in ((self.size_a, ","), (self.size_a, "|"),
                                                 (self.size_b, ","), (self.size_b, ";"))
                      for i in range(n)]
        self._cache: dict[str, tuple | None] = {}
        self._cache_bytes, self._cached = cache_bytes, 0

    def _proven(self, model: dict, special: set[str]) -> tiktoken.Encoding | None:
        """The faster library with A's vocabulary, if it is sure to give the same ids."""
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [vocab[a + b] for a, b in merges]
        if (order != sorted(set(order)) or len(order) + 256 != len(vocab)
                or any(len(self.a.model.tokenize(t)) != 1 for t in vocab)):
            return None
        return tiktoken.Encoding("A", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={self.bytes_a[i]: i for i in vocab.values()})

    def encode_a(self, stretches: list[str]) -> list[list[int]]:
        if self._fast is None:
            return [x.ids for x in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        plain = self._fast.encode_ordinary
        out = [None if _BEYOND_LATIN.search(s) else plain(s) for s in stretches]
        rest = [i for i, ids in enumerate(out) if ids is None]
        coded = self.a.encode_batch_fast([stretches[i] for i in rest], add_special_tokens=False)
        for i, x in zip(rest, coded):
            out[i] = x.ids
        return out

    def _align(self, stretches: list[str]) -> dict[str, tuple | None]:
        """Sizes, irregular links, regular groups' A ids (as bytes of 32-bit integers) and the
        groups' text of every stretch; None if B's tokens do not give the stretch back."""
        out: dict[str, tuple | None] = {}
        good = []
        for s, a, b in zip(stretches, self.encode_a(stretches), self._encode_b(stretches)):
            if b"".join(map(self.bytes_b.__getitem__, b)) == s.encode():
                good.append((s, a, b))
            else:
                out[s] = None
        if not good:
            return out
        names, coded_a, coded_b = zip(*good)
        n_a = np.fromiter(map(len, coded_a), np.int64, len(good))
        n_b = np.fromiter(map(len, coded_b), np.int64, len(good))
        ids_a = np.fromiter(chain.from_iterable(coded_a), np.int64, n_a.sum())
        ids_b = np.fromiter(chain.from_iterable(coded_b), np.int64, n_b.sum())
        ends_a, ends_b = np.cumsum(self._len_a[ids_a]), np.cumsum(self._len_b[ids_b])
        # between neighbouring ends of any token lie the bytes of one link
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        link_a, link_b = ids_a[at_a], ids_b[at_b]
        joint = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        alone = joint & np.concatenate([[True], joint[:-1]])
        regular = alone & (self.same[link_a] == link_b)
        last = np.searchsorted(ends, ends_a[np.cumsum(n_a) - 1])  # the last link of a stretch
        links = (link_a * self.size_b + link_b)[~regular].astype(np.int32).tobytes()
        same = link_a[regular].astype(np.int32).tobytes()
        link_ends = (4 * np.cumsum(~regular)[last]).tolist()
        same_ends = (4 * np.cumsum(regular)[last]).tolist()
        n_groups = np.diff(np.cumsum(joint)[last], prepend=0)
        sizes = np.stack([n_a, n_b, n_groups], axis=1).astype(np.int32).tobytes()
        # tokens as text, group by group, A's before B's
        cuts = ends[joint]
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        signs = np.concatenate([ids_a + self.size_a * (cuts[group_a] == ends_a),
                                2 * self.size_a + ids_b + self.size_b * (cuts[group_b] == ends_b)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        texts = list(map(self._text.__getitem__, signs[order].tolist()))
        x = y = z = 0
        for i, (name, x2, y2, z2) in enumerate(zip(names, link_ends, same_ends,
                                                   np.cumsum(n_a + n_b).tolist())):
            out[name] = (sizes[12 * i:12 * i + 12], links[x:x2], same[y:y2],
                         "".join(texts[z:z2]))
            x, y, z = x2, y2, z2
        return out

    def _encode_b(self, stretches: list[str]) -> list[list[int]]:
        """B puts a space in front itself; in front of a line break it goes again."""
        coded = self.b.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
        return [ids if s[0] == " " else ids[1:] for s, ids in zip(stretches, coded)]

    def stretches(self, texts: list[str]) -> list[tuple[list[str], dict]]:
        """The stretches of every text (none for an empty one) and a table of all of them."""
        cut = list(map(_cut, texts))
        known, missing = {}, []
        if self._cached > self._cache_bytes:
            self._cache.clear()
            self._cached = 0
        for s in set(chain.from_iterable(cut)):
            if s in self._cache:
                known[s] = self._cache[s]
            else:
                missing.append(s)
        for at in range(0, len(missing), 2000):
            some = missing[at:at + 2000]
            for s, found in self._align(some).items():
                known[s] = found
                if len(s) <= 64 and self._cached <= self._cache_bytes:
                    self._cache[s] = found
                    self._cached += 400 + 12 * len(s)  # what an entry takes, about
        return cut, known


def _cut(text: str) -> list[str]:
    """The stretches of " " + text."""
    if "\0" not in text and " ".join(text.split()) == text.replace("\n", " "):
        # nothing but single spaces and line breaks: the same cuts without a pattern
        parts = (" " + text).replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        return parts[1:] if text else []
    return _CUT.split(" " + text)


def _byte_signs() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@lru_cache(maxsize=1)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


keeps_tables(__name__, pair.cache_clear)


def _counted(parts) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.frombuffer(b"".join(parts), np.int32), return_counts=True)


def _ends(parts: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([len(p) for p in parts]).astype(np.int32)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)


def _block_row(both: Pair, ids: list, texts: list[str | None], vector: np.ndarray) -> dict:
    """One block's texts; ``vector`` gets its regular groups, by A id."""
    cut, known = both.stretches([t or "" for t in texts])
    counts, shas, link_parts, link_times, same_parts, same_times = [], [], [], [], [], []
    for parts in cut:
        found = list(map(known.__getitem__, parts))
        if not found or None in found:
            found = []
        sizes, links, same, groups = zip(*found) if found else ((), (), (), ())
        n = np.frombuffer(b"".join(sizes), np.int32).reshape(-1, 3).sum(axis=0, dtype=np.int64)
        for source, where, times in ((links, link_parts, link_times),
                                     (same, same_parts, same_times)):
            values, often = _counted(source)
            where.append(values)
            times.append(often)
        counts.append([*n.tolist(), int(link_times[-1].sum() + same_times[-1].sum())])
        shas.append(hashlib.sha256("".join(groups)[:-1].encode()).hexdigest() if found else "")
    links, times = _joined(link_parts), _joined(link_times)
    pairs, places = np.unique(links, return_inverse=True)
    same, same_n = _joined(same_parts), _joined(same_times)
    np.add.at(vector, same, same_n)
    n_a, n_b, n_groups, n_links = zip(*counts) if counts else ((), (), (), ())
    return {"doc_id": ids, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
            "groups_sha256": shas, "link_ends": _ends(link_parts),
            "links": places.astype(np.int32).ravel(), "link_times": times,
            "same_ends": _ends(same_parts), "same": same, "same_times": same_n,
            "pairs": pairs, "pair_times": np.bincount(places.ravel(), times, len(pairs)).astype(
                np.int64)}


def _blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int) -> DataFrame:
    """One row per block of texts; a last row of each task, without a block, has its vector of
    regular groups as (pair, count)."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(_BLOCK))

    def run(batches):
        only_tables_of(__name__)
        both = pair(path_a, path_b)
        vector = np.zeros(both.size_a, np.int64)
        block = TaskContext.get().partitionId() << 32
        for piece in pieces(batches, block_bytes):
            columns = piece.to_pydict()
            row = _block_row(both, columns["doc_id"], columns["text"], vector)
            yield pa.RecordBatch.from_pydict({"block": [block], **{k: [v] for k, v in
                                                                   row.items()}}, schema=out)
            block += 1
        used = np.flatnonzero(vector)
        empty = {name: [None] for name in out.names}
        yield pa.RecordBatch.from_pydict(
            {**empty, "pairs": [(used * both.size_b + both.same[used]).astype(np.int32)],
             "pair_times": [vector[used]]}, schema=out)

    return docs.mapInArrow(run, _BLOCK)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
          text_col: str = "text", block_bytes: int = 1 << 20) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    Null and empty texts, and texts that either tokenizer's tokens do not give back, have zeros
    and an empty ``groups_sha256`` and add nothing to the counts. Repeated rows count and come
    back as often as they are there; a null id stays null; other columns are not read. An empty
    table gives an empty result. ``block_bytes`` bounds what a row of the intermediate tables
    holds (a text longer than it is a block of its own).
    """
    blocks = stage(_blocks(columns_of(docs, doc_id=id_col, text=text_col), path_a, path_b,
                           block_bytes), "alignment-blocks")
    size_a, size_b = _sizes(path_a, path_b)
    each = blocks.select("block", F.explode(F.arrays_zip("pairs", "pair_times")).alias("p"))
    each = each.select("block", F.col("p.pairs").alias("pair"), F.col("p.pair_times").alias("n"))
    regular = each.where("block IS NULL").groupBy("pair").agg(F.sum("n").alias("n"))
    irregular = each.where("block IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stage(irregular.unionByName(regular).groupBy("pair").agg(F.sum("n").alias("n")),
                   "pair-counts")
    b_id = F.col("pair") % F.lit(size_b)
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    told = stage(counts.withColumn("b", b_id).join(most, "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-answers")

    # regular groups: two vectors of A's vocabulary length, whatever the corpus
    vector_n, vector_best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    for row in told.join(regular.select("pair"), "pair", "left_semi").toLocalIterator():
        vector_n[row["pair"] // size_b] = row["n"]
        vector_best[row["pair"] // size_b] = row["best"]

    asked = blocks.where("block IS NOT NULL").select(
        "block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(told, "pair").groupBy("block").agg(
        F.collect_list(F.struct("place", "n", "best")).alias("answers"))
    answers = answers.select("block", *[F.col(f"answers.{c}").alias(c)
                                        for c in ("place", "n", "best")])
    answered = blocks.where("block IS NOT NULL").drop("pairs", "pair_times").join(
        stage(answers, "block-answers"), "block", "left")
    return _texts(answered, vector_n, vector_best)


def _sizes(path_a: str, path_b: str) -> tuple[int, int]:
    size_a = max(Tokenizer.from_file(path_a).get_vocab(with_added_tokens=True).values()) + 1
    return size_a, sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()


def _texts(answered: DataFrame, vector_n: np.ndarray, vector_best: np.ndarray) -> DataFrame:
    """The blocks' texts, a row each, with the answers to their links added up."""
    out = to_arrow_schema(StructType.fromDDL(_RESULT))

    def row_of(column) -> np.ndarray:
        return column.values.to_numpy(zero_copy_only=False)

    def added(values, ends) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(values)])
        return upto[ends] - upto[np.concatenate([[0], ends[:-1]])]

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                n = best = np.empty(0, np.int64)
                if row["place"].is_valid:
                    place = row_of(row["place"])
                    n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                    n[place] = row_of(row["n"])
                    best[place] = row_of(row["best"])
                links, times = row_of(row["links"]), row_of(row["link_times"]).astype(np.int64)
                same, often = row_of(row["same"]), row_of(row["same_times"]).astype(np.int64)
                link_ends, same_ends = row_of(row["link_ends"]), row_of(row["same_ends"])
                totals = {name: added(by[links] * times, link_ends)
                          + added(vector[same] * often, same_ends)
                          for name, by, vector in (("n_best", best, vector_best),
                                                   ("count_sum", n, vector_n))}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(totals[f.name]) if f.name in totals
                     else row[f.name].values.cast(f.type) for f in out], schema=out)

    return answered.mapInArrow(run, _RESULT)
