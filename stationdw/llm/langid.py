"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits. One binary n-gram classifier per bit says on which
side of the bit a text lies; a text's bits are then decoded to the nearest codeword. Decoding is
loss-weighted: the loss of a bit counts, for each language, by how often that bit's classifier
was right for that language on rows kept apart for it. A text whose two nearest codewords are
almost equally near is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, columns_of, stage

UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_CHUNK = 1 << 18  # characters handled at once, so that a very long text needs bounded memory
_MIX = np.uint32(0x9E3779B1)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords as rows of +1/-1. Up to six classes every split of the classes is a bit;
    beyond that the best of 200 seeded random codes of 15 * log2(n) bits by least distance."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        bits = [b for b in itertools.product((1, -1), repeat=n) if b[0] == 1 and -1 in b]
        return np.array(bits, np.int8).T
    rng, width, best, best_apart = np.random.default_rng(seed), int(15 * np.log2(n)), None, -1
    for _ in range(200):
        code = rng.choice(np.array([1, -1], np.int8), (n, width))
        code = code[:, np.abs(code.sum(0, dtype=np.int64)) < n]  # no bit without two sides
        same = code.astype(np.int32) @ code.T.astype(np.int32)
        apart = (code.shape[1] - same[~np.eye(n, dtype=bool)].max()) / 2
        if apart > best_apart:
            best, best_apart = code, apart
    return best


def letters(text: str) -> str | None:
    """Lower-cased letters with single spaces for all else; None if there is no letter."""
    clean = _NOT_LETTERS.sub(" ", text.lower())
    return f" {clean.strip()} " if any(map(str.isalpha, clean)) else None


def grams(clean: str, size: int):
    """Hashed 2-, 3- and 4-grams of characters, together, in pieces of bounded length."""
    codes = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32)
    mask, shift = np.uint32(size - 1), np.uint32(15)
    for at in range(0, len(codes), _CHUNK):
        part = codes[at:at + _CHUNK + 3]
        h, found = part * _MIX, []
        for n in (2, 3, 4):
            if len(part) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> shift)) * _MIX + part[n - 1:]
            mixed = (h ^ (h >> shift)) * _MIX
            # grams that start in the overlap belong to the next piece
            found.append(((mixed ^ (mixed >> shift)) & mask)
                         [:_CHUNK if at + _CHUNK < len(codes) else None])
        if found:
            yield np.concatenate(found)


@dataclass
class LanguageModel:
    """What a fitted model is: a few megabytes whatever the corpus, safe to send to every task."""

    languages: list[str]
    code: np.ndarray      # languages x bits, +1/-1
    weights: np.ndarray   # bits x n-gram buckets: log odds of the two sides of a bit
    trust: np.ndarray     # languages x bits: share of right answers, rows sum to 1
    sharpness: float = 4.0

    def bits(self, clean: str) -> np.ndarray:
        """Mean log odds over the text's n-grams, one value per bit."""
        total, n, size = np.zeros(self.code.shape[1]), 0, self.weights.shape[1]
        for g in grams(clean, size):
            total += (self.weights[:, g].sum(axis=1) if len(g) < 1000 else
                      self.weights @ np.bincount(g, minlength=size).astype(np.float32))
            n += len(g)
        return total / max(n, 1)

    def losses(self, clean: str) -> np.ndarray:
        """Loss of each language's codeword: trust-weighted exponential loss of the bits."""
        agree = self.code * np.clip(self.bits(clean) * self.sharpness, -8, 8)
        return (self.trust * np.exp(-agree)).sum(axis=1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score between 0 and 1, and whether two codewords are about as near."""
        clean = letters(text) if text else None
        if clean is None or not self.languages:
            return UNDETERMINED, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = self.losses(clean)
        order = np.argsort(loss, kind="stable")
        near = 1.0 / loss[order]
        return (self.languages[order[0]], float(near[0] / near.sum()),
                bool(loss[order[0]] > 0.9 * loss[order[1]]))


def _sample(rows: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` labelled rows of each language, the same ones at every run: rows
    whose hashed id lies below the share that this needs (one small table of counts)."""
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return rows
    share = F.create_map(*[F.lit(x) for lang, n in counts.items()
                           for x in (lang, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_000)) / 1e6
    return rows.where(drawn < F.element_at(share, F.col("lang")))


def _gram_counts(rows: DataFrame, size: int) -> DataFrame:
    def run(batch):
        counts: dict[str, np.ndarray] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            if (clean := letters(text)) is not None:
                own = counts.setdefault(lang, np.zeros(size, np.int64))
                for g in grams(clean, size):
                    own += np.bincount(g, minlength=size)
        out = {"lang": [], "gram": [], "n": []}
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            out["lang"] += [lang] * len(at)
            out["gram"] += at.tolist()
            out["n"] += own[at].tolist()
        return out

    return (arrow_map(rows.select("lang", "text"), run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, per_language: int = 2000, size: int = 1 << 15, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> LanguageModel:
    """Fit on rows whose crc32(id) mod ``folds`` is not 0; fold ``folds - 1`` gives the trust.

    At most about ``per_language`` rows of a language are read (the documented bound of the fit);
    of these, n-gram counts are summed by Spark and ``languages * size`` sums reach the driver.
    Rows with a null text or language teach nothing; without any labelled row the model knows no
    language and calls every text undetermined.
    """
    rows = columns_of(docs, doc_id=id_col, text=text_col, lang=lang_col)
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds, F.lit(1))
    rows = stage(_sample(rows.where(fold != 0), per_language).withColumn("fold", fold),
                 "language-sample")
    counts = _gram_counts(rows.where(F.col("fold") != folds - 1), size).toPandas()
    languages = sorted(counts["lang"].unique().tolist())
    code = codewords(len(languages))
    if not languages:
        return LanguageModel([], code, np.zeros((1, size), np.float32), np.ones((0, 1)))
    table = np.full((len(languages), size), 0.5)
    row = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    table[row, counts["gram"].to_numpy()] += counts["n"].to_numpy()
    share = table / table.sum(axis=1, keepdims=True)  # every language weighs the same
    sides = [np.where((code == s)[:, :, None], share[:, None, :], 0).sum(0)
             / np.maximum((code == s).sum(0), 1)[:, None] for s in (1, -1)]
    weights = (np.log(np.maximum(sides[0], 1e-12)) - np.log(np.maximum(sides[1], 1e-12)))
    weights = np.ascontiguousarray(weights.astype(np.float32))
    model = LanguageModel(languages, code, weights, np.full(code.shape, 1 / code.shape[1]))
    if len(languages) > 1:
        model.trust = _trust(rows.where(F.col("fold") == folds - 1), model)
    return model


def _trust(rows: DataFrame, model: LanguageModel) -> np.ndarray:
    def run(batch):
        out = {"lang": [], "bit": [], "right": [], "n": []}
        for lang, text in zip(batch["lang"], batch["text"]):
            clean = letters(text)
            if clean is not None and lang in model.languages:
                right = model.bits(clean) * model.code[model.languages.index(lang)] > 0
                out["lang"] += [lang] * len(right)
                out["bit"] += range(len(right))
                out["right"] += right.astype(int).tolist()
                out["n"] += [1] * len(right)
        return out

    seen = (arrow_map(rows.select("lang", "text"), run, "lang string, bit int, right int, n int")
            .groupBy("lang", "bit").agg(F.sum("right").alias("right"), F.sum("n").alias("n")))
    right, n = np.ones(model.code.shape), np.full(model.code.shape, 2.0)
    for r in seen.collect():  # languages x bits rows
        at = model.languages.index(r["lang"]), r["bit"]
        right[at] += r["right"]
        n[at] += r["n"]
    share = right / n
    return share / share.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
            text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for every row (one map, no shuffle).

    ``lang_pred`` is ``und`` with score 0 for null texts and texts without a letter. Repeated
    rows give repeated results; a null id counts as not held out. Only the text is looked at;
    ``keep`` names input columns that are carried along.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # megabytes: languages x bits x buckets
    read = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"),
                       *[docs[c].alias(f"_keep_{c}") for c in keep])
    kept = [f.name for f in read.schema][2:]

    def run(batch):
        got = [shared.value.predict(t) for t in batch["_text"]]
        return {"_id": batch["_id"], "lang_pred": [g[0] for g in got],
                "score": [g[1] for g in got], "ambiguous": [g[2] for g in got],
                **{c: batch[c] for c in kept}}

    types = {f.name: f.dataType.simpleString() for f in read.schema}
    schema = ", ".join(["_id long, lang_pred string, score double, ambiguous boolean",
                        *[f"`{c}` {types[c]}" for c in kept]])
    held = F.coalesce(F.crc32(F.col("_id").cast("string")) % 5 == 0, F.lit(False))
    out = arrow_map(read, run, schema)
    return out.select(F.col("_id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score",
                      "ambiguous", *[F.col(c).alias(c[6:]) for c in kept])
