import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stationdw.llm import langid
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import docs


@pytest.fixture(scope="module")
def told(spark):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    return langid.predict(d, langid.fit(d), keep=("lang",)).toPandas()


def test_held_out_accuracy(told):
    held = told[told.held_out]
    assert len(held) > 100
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert set(told.lang_pred) <= {"en", "fr", "de", "es", "und"}
    assert told.score.between(0, 1).all()


def test_folds_follow_crc32(told):
    assert told.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in told.doc_id]


def test_held_out_rows_teach_nothing(spark):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text", "lang")
    held = "crc32(cast(doc_id as string)) % 5 = 0"
    wrong = d.selectExpr("doc_id", "text", f"case when {held} then 'xx' else lang end as lang")
    a, b = langid.fit(d), langid.fit(wrong)
    assert a.languages == b.languages
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.trust, b.trust)


def test_awkward_rows(spark):
    d = docs(spark)
    got = langid.predict(d, langid.fit(d), keep=("size",)).toPandas()
    assert len(got) == d.count() and (got["size"] == 2).all()
    by_id = dict(zip(got.doc_id, got.lang_pred))
    assert by_id[2] == by_id[3] == by_id[4] == by_id[5] == "und"
    assert (got[got.lang_pred == "und"].score == 0).all()


def test_nothing_to_learn_from(spark):
    d = docs(spark, [(1, "some text", None, None), (2, None, "en", None)])
    assert langid.predict(d, langid.fit(d)).toPandas().lang_pred.tolist() == ["und", "und"]
    empty = docs(spark, [])
    assert langid.predict(empty, langid.fit(empty)).count() == 0


def test_one_language_is_always_it(spark):
    d = docs(spark, [(i, "only one tongue here", "en", None) for i in range(1, 12)])
    assert set(langid.predict(d, langid.fit(d)).toPandas().lang_pred) == {"en"}


@pytest.mark.parametrize("n", [2, 3, 4, 6, 9, 20])
def test_codewords_are_apart(n):
    code = langid.codewords(n).astype(int)
    apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert min(apart) >= (1 if n == 2 else 2)
    assert (np.abs(code.sum(0)) < n).all()


def test_decoding_corrects_a_wrong_bit():
    code = langid.codewords(4)
    model = langid.LanguageModel(list("abcd"), code, np.zeros((7, 8), np.float32),
                                 np.full((4, 7), 1 / 7))
    for k in range(4):
        for wrong in range(7):
            bits = code[k].astype(float).copy()
            bits[wrong] *= -1
            model.bits = lambda _, b=bits: b
            assert int(np.argmin(model.losses(""))) == k


def test_level_bits_are_flagged():
    model = langid.LanguageModel(list("abcd"), langid.codewords(4),
                                 np.zeros((7, 8), np.float32), np.full((4, 7), 1 / 7))
    assert model.predict("some text")[2]


def test_pieces_of_a_long_text_give_all_grams(monkeypatch):
    text = langid.letters("the quick brown fox jumps over the lazy dog " * 40)
    whole = np.bincount(np.concatenate(list(langid.grams(text, 1 << 10))), minlength=1 << 10)
    monkeypatch.setattr(langid, "_CHUNK", 100)
    cut = np.bincount(np.concatenate(list(langid.grams(text, 1 << 10))), minlength=1 << 10)
    assert np.array_equal(whole, cut)


def plain_grams(text, size):
    """Buckets of a text's 2-, 3- and 4-grams by scalar arithmetic, None without a letter."""
    clean = re.sub(r"[\W\d_]+", " ", text.lower()).strip()
    if not any(c.isalpha() for c in clean):
        return None
    codes, out, full = [ord(c) for c in f" {clean} "], Counter(), 1 << 32
    for i in range(len(codes)):
        h = codes[i] * 0x9E3779B1 % full
        for c in codes[i + 1:i + 4]:
            h = ((h ^ h >> 15) * 0x9E3779B1 + c) % full
            mixed = (h ^ h >> 15) * 0x9E3779B1 % full
            out[(mixed ^ mixed >> 15) % size] += 1
    return out


def brute(rows, size=1 << 15):
    """Fit and predict in plain Python: doc_id -> (language, score)."""
    told = [(i, lang, plain_grams(t, size), zlib.crc32(str(i).encode()) % 5)
            for i, t, lang in rows if t is not None]
    known = [r for r in told if r[1] is not None and r[2] is not None and r[3]]
    langs = sorted({r[1] for r in known})
    counts = {x: Counter() for x in langs}
    for _, lang, g, fold in known:
        if fold != 4:
            counts[lang].update(g)
    total = {x: sum(counts[x].values()) + size / 2 for x in langs}
    splits = [b for b in range(1, 2 ** (len(langs) - 1))]  # the first language is always +1
    sign = {x: [-1 if i and s >> len(langs) - 1 - i & 1 else 1 for s in splits]
            for i, x in enumerate(langs)}

    def bits(g):
        out = []
        for b in range(len(splits)):
            value = 0.0
            for bucket, n in g.items():
                mean = []
                for side in (1, -1):
                    of = [x for x in langs if sign[x][b] == side]
                    mean.append(sum((counts[x][bucket] + 0.5) / total[x] for x in of) / len(of))
                value += n * math.log(mean[0] / mean[1])
            out.append(value / sum(g.values()))
        return out

    right = {x: [1] * len(splits) for x in langs}
    seen = Counter()
    for _, lang, g, fold in known:
        if fold == 4:
            seen[lang] += 1
            right[lang] = [r + (v * s > 0) for r, v, s in zip(right[lang], bits(g), sign[lang])]
    trust = {x: [r / (seen[x] + 2) for r in right[x]] for x in langs}
    out = {}
    for i, t, _ in rows:
        g = plain_grams(t, size) if t else None
        if g is None:
            out[i] = ("und", 0.0)
            continue
        value = bits(g)
        near = {x: sum(trust[x]) / sum(w * math.exp(-s * max(-8, min(8, 4 * v)))
                                       for w, s, v in zip(trust[x], sign[x], value)) for x in langs}
        best = max(langs, key=near.get)
        out[i] = (best, near[best] / sum(near.values()))
    return out


def test_equals_a_brute_force_version(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in d.orderBy("doc_id").limit(120).collect()] + [(10 ** 6, None, "en"),
                                                                         (10 ** 6 + 1, "12 !", "fr")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = brute(rows)
    got = langid.predict(d, langid.fit(d)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["lang_pred"] == want[r["doc_id"]][0]
        assert r["score"] == pytest.approx(want[r["doc_id"]][1], abs=1e-3)
