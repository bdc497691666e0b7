import random

import numpy as np
import pytest

from stationdw.llm import substrings
from tests.llm.helpers import docs


def brute(rows, window):
    words = [(i, substrings.words_of(t)) for i, t in rows]
    least: dict = {}
    for i, w in words:
        if i is not None:
            for p in range(len(w) - window + 1):
                k = tuple(w[p:p + window])
                least[k] = min(i, least.get(k, i))
    out = []
    for i, w in words:
        gone = np.zeros(len(w), bool)
        if i is not None:
            for p in range(len(w) - window + 1):
                if least[tuple(w[p:p + window])] < i:
                    gone[p:p + window] = True
        out.append((i, len(w), int(gone.sum()),
                    b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("period", [1, 2, 3, 5, 7, 13, 21, 30])
def test_cover(period):
    cover = substrings.difference_cover(period)
    for i in range(period):
        for j in range(period):
            assert any((i + s) % period in cover and (j + s) % period in cover
                       for s in range(period))
    if period in (7, 13, 21):
        assert len(cover) == {7: 3, 13: 4, 21: 5}[period]


@pytest.mark.parametrize("window,period", [(10, 4), (12, 7), (50, 21), (5, 5), (3, 1)])
def test_random_texts(spark, window, period):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(6 if window < 6 else 40)]
    passages = [rng.choices(vocabulary, k=rng.randint(window - 2, 3 * window)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += rng.choices(vocabulary, k=rng.randint(0, window))
            text += rng.choice(passages)
        rows.append((i, " ".join(text), "en", "s"))
    rows += [(rng.randint(0, 90), rng.choice(rows)[1], "en", "s") for _ in range(10)]
    got = substrings.dedup_substrings(docs(spark, rows), window, period).collect()
    want = brute([r[:2] for r in rows], window)
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert sum(r[2] for r in want) > 0


def test_awkward_rows(spark):
    d = docs(spark)
    got = substrings.dedup_substrings(d, 5, 3).collect()
    want = brute([(r["doc_id"], r["text"]) for r in d.collect()], 5)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert substrings.dedup_substrings(docs(spark, [])).count() == 0


def test_window_hashes_match_words():
    words = [f"{i % 7}".encode() for i in range(300)]
    h = substrings.window_hashes(words, 20, substrings._BASES[0])
    for i in range(0, 281, 13):
        for j in range(281):
            assert (h[i] == h[j]) == (words[i:i + 20] == words[j:j + 20])
