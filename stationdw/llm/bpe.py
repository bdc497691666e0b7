"""BPE encoding and decoding with forced-boundary splitting.

Two neighbouring symbols that never stand side by side inside any vocabulary token can never be
merged across: such a pair marks a certain cut. Every pre-token is cut at these places, the
fragments are merged independently of each other, and their tokens are concatenated. The
tokenizer file (normalisation, pre-token pattern, vocabulary, merges, word-end suffix and
special strings) is read from its path; nothing of it is copied here.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import arrow_map, columns_of, keeps_tables


def _byte_alphabet() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = [""] * 256, 0
    for b in range(256):
        if b in keep:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + extra)
            extra += 1
    return table


def unpack(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


class _Words(dict):
    """Pre-token -> packed ids; unknown ones are encoded and kept while there is room."""

    def __init__(self, encode, limit: int, longest: int = 64):
        super().__init__()
        self._encode, self._limit, self._longest = encode, limit, longest

    def __missing__(self, word: str) -> bytes:
        packed = self._encode(word)
        if len(word) <= self._longest:
            if len(self) >= self._limit:
                self.clear()
            self[word] = packed
        return packed


class WordBpe:
    """Encoder and decoder for a byte-level BPE with a word-end suffix and lower-casing."""

    def __init__(self, path: str, cache_size: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (steps != ["NFC", "Replace", "Lowercase"] or not split["invert"]
                or split["behavior"] != "Removed" or level["add_prefix_space"]
                or spec["decoder"] is not None or model["type"] != "BPE"):
            raise ValueError("not a word-end BPE file of the supported kind")
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                 for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.vocab.update(self.special)
        self.tokens = [""] * (max(self.vocab.values()) + 1)
        for token, i in self.vocab.items():
            self.tokens[i] = token
        self._special_cut = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
            + ")") if self.special else None
        # \s of the file means Unicode white space
        pattern = split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}")
        self._pre_tokens = regex.compile(pattern).findall
        self._bytes = _byte_alphabet()
        # neighbours inside a vocabulary token; only these can be joined by a merge
        self.inside = {p for t in model["vocab"] for p in self._neighbours(t)}
        self._known = _Words(self._word, cache_size)

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and token != self.suffix:
            body = list(token[:-len(self.suffix)])
            body[-1] += self.suffix
            return body
        return list(token)

    def _neighbours(self, token: str):
        symbols = self._symbols(token)
        return zip(symbols, symbols[1:])

    def _merge(self, symbols: list[str]) -> list[str]:
        """Lowest rank first, leftmost first, until no neighbours can be joined."""
        rank, none = self.rank, len(self.rank)
        if len(symbols) <= 256:
            ranks = [rank.get(p, none) for p in zip(symbols, symbols[1:])]
            while ranks and (r := min(ranks)) < none:
                i = ranks.index(r)
                symbols[i] += symbols.pop(i + 1)
                del ranks[i]
                if i:
                    ranks[i - 1] = rank.get((symbols[i - 1], symbols[i]), none)
                if i < len(ranks):
                    ranks[i] = rank.get((symbols[i], symbols[i + 1]), none)
            return symbols
        # long fragments: the same order from a heap over a linked list
        nxt, prv = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        end = len(symbols)
        heap = [(rank[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
        heapq.heapify(heap)
        alive = [True] * end
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or symbols[i] != a or j >= end or symbols[j] != b:
                continue
            symbols[i], alive[j], nxt[i] = a + b, False, nxt[j]
            if nxt[i] < end:
                prv[nxt[i]] = i
            for left, right in ((prv[i], i), (i, nxt[i])):
                if left >= 0 and right < end and (r := rank.get((symbols[left], symbols[right]))) \
                        is not None:
                    heapq.heappush(heap, (r, left, symbols[left], symbols[right]))
        return [s for s, ok in zip(symbols, alive) if ok]

    def fragments(self, pre_token: str) -> list[list[str]]:
        """A pre-token's byte symbols, cut wherever no vocabulary token has the two together."""
        symbols = [self._bytes[b] for b in pre_token.encode()]
        symbols[-1] += self.suffix
        cuts = [i for i, p in enumerate(zip(symbols, symbols[1:]), 1) if p not in self.inside]
        return [symbols[i:j] for i, j in zip([0, *cuts], [*cuts, len(symbols)])]

    def _word(self, word: str) -> bytes:
        ids = [self.vocab[t] for part in self.fragments(word) for t in self._merge(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return list(map(self._known.__getitem__, self._pre_tokens(text.lower())))

    def encode_packed(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._special_cut is None or "<" not in text:
            return b"".join(self._plain(text))
        out: list[bytes] = []
        for part in self._special_cut.split(text):
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                out += self._plain(part)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return unpack(self.encode_packed(text))

    def decode(self, ids) -> str:
        """Tokens joined by a space (the file names no decoder)."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


keeps_tables(__name__, tokenizer.cache_clear)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
                   ) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row (one map, no shuffle).

    Null and empty texts have no tokens and decode to the empty text; repeated rows give
    repeated results; other columns are not read.
    """
    def rows(batch):
        tok = tokenizer(path)
        n, ids, decoded = [], [], []
        for text in batch["text"]:
            packed = tok.encode_packed(text)
            n.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(tok.decode(unpack(packed)).encode()).hexdigest())
        return {"doc_id": batch["doc_id"], "n_tokens": n, "ids_sha256": ids,
                "decoded_sha256": decoded}

    return arrow_map(columns_of(docs, doc_id=id_col, text=text_col), rows,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
           ) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the token ids of every row and their decoded text,
    with the same rules as ``bpe_round_trip``."""
    def rows(batch):
        tok = tokenizer(path)
        packed = [tok.encode_packed(t) for t in batch["text"]]
        return {"doc_id": batch["doc_id"], "n_tokens": [len(p) // 4 for p in packed],
                "ids": [np.frombuffer(p, "<i4") for p in packed],
                "decoded": [tok.decode(unpack(p)) for p in packed]}

    return arrow_map(columns_of(docs, doc_id=id_col, text=text_col), rows,
                     "doc_id long, n_tokens long, ids array<int>, decoded string")
