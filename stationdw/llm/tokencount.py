"""Token counts by the whole-token shortcut (BPE pieces with byte fallback).

Offline, once per process, every vocabulary string is encoded on its own; those that come back
as one token are *proven* and count 1 wherever they stand as a whole pre-token. Pre-tokens are
cut where no piece of the vocabulary can reach across: in front of a run of spaces (no piece has
a space after a non-space) and on both sides of a line break (in no piece at all, one byte
token). Both facts are checked against the vocabulary when it is loaded. Only pre-tokens that
are not proven are merged, by the library, and remembered in a bounded table.
"""

from __future__ import annotations

import re
from functools import lru_cache

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, columns_of, keeps_tables

SPACE = "▁"  # how the model writes a space
_RUNS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


class _Counts(dict):
    """Pre-token -> number of tokens; unknown ones are merged and kept while there is room."""

    def __init__(self, proven, merge, limit: int, longest: int = 64):
        super().__init__(dict.fromkeys(proven, 1))
        self._merge, self._limit, self._longest = merge, limit + len(self), longest
        self._proven = proven

    def __missing__(self, word: str) -> int:
        n = self._merge(word)
        if len(word) <= self._longest:
            if len(self) >= self._limit:
                self.clear()
                self.update(dict.fromkeys(self._proven, 1))
            self[word] = n
        return n


class PieceCounter:
    """Counts tokens as ``SentencePieceProcessor.encode`` does, without building them."""

    def __init__(self, path: str, cache_size: int = 500_000):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.vocab_size())
        pieces = [self.model.id_to_piece(i) for i in ids
                  if not (self.model.is_control(i) or self.model.is_unknown(i)
                          or self.model.is_unused(i) or self.model.is_byte(i))]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece has a space after a non-space: spaces are no sure cuts")
        if any("\n" in p for p in pieces):
            raise ValueError("a piece holds a line break: line breaks are no sure cuts")
        if len(self.model.encode("\n")) != 2:
            raise ValueError("a line break must be one byte token behind the leading space")
        self.proven = {p for p in pieces if self._merge(p) == 1}
        self._any = _Counts(self.proven, self._merge, cache_size)
        # the same table keyed without the leading space: what text.split(" ") gives
        self._spaced = _Counts({p[1:] for p in self.proven if p[:1] == SPACE},
                               lambda w: self._merge(SPACE + w), cache_size)

    def _merge(self, pre_token: str) -> int:
        """Tokens of one pre-token written with the model's spaces."""
        if pre_token[:1] == SPACE:  # the library puts one space in front of every text
            rest = pre_token[1:]
            return len(self.model.encode(rest.replace(SPACE, " "))) if rest else 1
        return len(self.model.encode("\n" + pre_token)) - 2  # lone space, line break, pre-token

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if text[0] == " " or "  " in text or SPACE in text or "\n " in text:
            marked = SPACE + text.replace(" ", SPACE)
            table, n = self._any, 0
            for m in _RUNS.finditer(marked):
                n += 1 if m.group() == "\n" else table[m.group()]
            return n
        first, *lines = text.split("\n")
        n = len(lines) + sum(map(self._spaced.__getitem__, first.split(" ")))
        for line in lines:
            if line:
                head, *words = line.split(" ")
                n += self._any[head] + sum(map(self._spaced.__getitem__, words))
        return n


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


keeps_tables(__name__, counter.cache_clear)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row (one map, no shuffle).

    A null or empty text has 0 bytes and 0 tokens and is never over the limit; repeated rows
    give repeated results; a null id stays null. Columns other than id and text are not read.
    """
    def rows(batch):
        count = counter(model_path).count
        return {"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"],
                "n_tokens": [count(t) for t in batch["text"]]}

    read = columns_of(docs, doc_id=id_col, text=text_col)
    read = read.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = arrow_map(read, rows, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
