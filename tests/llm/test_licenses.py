"""Licence scan against a version that tries every template at every place of every text."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stationdw.llm import licenses

from .helpers import LONG, TEXTS, docs

SLACK = 6


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def best_share(ws, text):
    """The best share over all places where every key phrase stands within the slack."""
    parts, template = [], []
    for part in re.split(r"(\[[^]]*\])", text):
        if part.startswith("["):
            parts.append((len(template), split(part)))
        template += split(part)
    starts = [[x for x in range(len(ws)) if ws[x:x + len(p)] == p] for _, p in parts]
    best = 0.0
    for x in starts[0]:
        shift = x - parts[0][0]
        chosen = [(0, shift)]
        for (at, _), xs in zip(parts[1:], starts[1:]):
            near = [y - at for y in xs if abs(y - at - shift) <= SLACK]
            if near:
                chosen.append((at, min(near, key=lambda s: (abs(s - shift), s))))
        if len(chosen) == len(parts):
            ends = [at for at, _ in chosen[1:]] + [len(template)]
            there = sum(0 <= i + s < len(ws) and ws[i + s] == template[i]
                        for (at, s), end in zip(chosen, ends) for i in range(at, end))
            best = max(best, there / len(template))
    return best


def brute(rows):
    out = []
    for doc, text in rows:
        ws = split(text or "")
        base = [(x, label) for phrase, label in licenses.PHRASES.items()
                for x in range(len(ws)) if ws[x:x + len(phrase.split())] == phrase.split()]
        found = {}
        for label, template in licenses.TEMPLATES:
            share = best_share(ws, template)
            if share:
                found[label] = max(found.get(label, 0), share)
        labels = {label for _, label in base}
        out.append((doc, len(ws), len(base), min((x for x, _ in base), default=None),
                    max((x for x, _ in base), default=None), ",".join(sorted(labels)),
                    ",".join(sorted(labels | found.keys())),
                    1.0 if base else max(found.values(), default=0.0)))
    return Counter(out)


def result(df):
    return Counter(tuple(r) for r in df.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
        "score").collect())


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in TEXTS]
    assert result(licenses.scan(docs(spark))) == brute(rows)


def test_planted_templates(spark):
    """Whole templates, with words lost, added and changed, two in one text, cut phrases, other
    scripts in between, and a very long text with a licence at its end."""
    rng = random.Random(9)
    rows = []
    plain = [re.sub(r"[\[\]]", "", t) for _, t in licenses.TEMPLATES]
    for i in range(400):
        ws = " ".join(rng.choice(plain) for _ in range(rng.choice([1, 1, 2]))).split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(ws))
            ws[at:at + rng.randrange(2)] = rng.choice([[], ["new"], ["the", "the"], ["Größe"]])
        lead = ["lorem", "Software", "permission", "license", "the"] * rng.randrange(3)
        rows.append((i, rng.choice([" ", "\n", " -- "]).join(lead + ws + lead)))
    rows += [(1000, LONG * 3 + " " + plain[0]), (1001, "MIT\nLicense, the MIT-license. mit licenses"),
             (1002, "permission hereby granted of charge any person"), (1002, "MIT License")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(licenses.scan(frame)) == brute(rows)


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_words_in_steps(step):
    text = "MIT License 日本ü a--b ÀB " * 40
    got = [w.decode() for some in licenses._words(text.encode().lower(), step) for w in some]
    assert got == split(text)


def test_given_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    got = result(licenses.scan(frame))
    assert got == brute(rows)
    assert any("cc-by-nc" in r[6] for r in got) and any(r[5] == "mit" for r in got)


def test_rare_words_are_those_of_the_corpus_and_clashing_columns(spark):
    number = licenses.vocabulary(licenses.TEMPLATES)
    idf = {w: 5.0 for w in number} | {"hereby": 9.0, "granted": 0.1}
    index = licenses.Index(licenses.TEMPLATES, idf, 3, SLACK)
    assert index.keys[0][0] == number["hereby"] and number["granted"] not in index.keys[0]
    frame = spark.createDataFrame([(1, "MIT License")], "doc_id long, text string")
    for name in ("ids", "at", "n_words", "id", "count"):
        frame = frame.withColumn(name, F.lit("x"))
    assert result(licenses.scan(frame)) == brute([(1, "MIT License")])
    assert licenses.scan(frame.limit(0)).count() == 0
