"""The prefix trie against plain dictionaries of whole prefixes."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stationdw.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by[c].append((turn is not None, turn or 0, role, key, text))
    own = {c: [(r, x) for _, _, r, _, x in sorted(ts)] for c, ts in by.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        # SQL's remainder has the sign of c
        out[c] = own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + ts[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter(
        (cs[0], len(p), members[p[:-1]][0] if p else None, len(cs), children[p], leaves[p],
         saved[p], hashlib.sha256(",".join(
             str(c) for c in cs if len(convs[c]) == len(p)).encode()).hexdigest())
        for p, cs in members.items())


def nodes(df):
    return Counter(tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256").collect())


def query(frame):
    return trie.prefix_trie(*trie.shared_beginnings(trie.turns(frame)))


def test_awkward_rows(spark, monkeypatch):
    """Nulls everywhere, ties, repeated turns, copies, turnless conversations, a long one, negative
    and missing ids, clashing extra columns."""
    monkeypatch.setattr(trie, "_IDS", 4)
    rng = random.Random(3)
    rows = [(None, 1, "user", "no conversation"), (None, None, None, None)]
    for c in [*range(-12, 60), 10_000_000_000, 10_000_000_003]:
        n = rng.randrange(1, 14)
        hot = rng.random() < 0.4  # a third and more share a beginning or are whole copies
        for t in range(n):
            shared = hot and t < 9
            rows.append((c, t if rng.random() < 0.95 else None,
                         "user" if shared else rng.choice(["user", "assistant", None]),
                         f"hällo {t}" if shared else rng.choice(["a", "", None, "x" * 5, "日本"])))
    rows += [(33, 5, "user", "again"), (33, 5, "user", "again"), (33, 5, None, "again")]
    rows += [(44, t, "user", f"hällo {t}") for t in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("c", "p", "key", "n", "d", "rep", "length"):
        frame = frame.withColumn(name, F.lit(7))
    assert nodes(query(frame)) == brute(rebuilt(rows))


@pytest.mark.parametrize("block", [1, 3])
def test_any_block_length_gives_the_same_trie(spark, block):
    """Chains hanging on chains: conversation i shares its first i turns with conversation i+1."""
    convs = {i: [("user", f"{t}" if t <= i else f"{t} of {i}") for t in range(i + 1 + i % 4)]
             for i in range(25)}
    convs |= {100: [], 101: [], 50: convs[7], 51: convs[7][:3], 52: convs[7], 53: convs[7]}
    rows = [(c, t, r, x) for c, ts in convs.items() for t, (r, x) in enumerate(ts)]
    own = trie.turns(spark.createDataFrame(rows, SCHEMA))
    lengths = spark.createDataFrame([(c, len(ts)) for c, ts in convs.items()], "c long, length long")
    assert nodes(trie.prefix_trie(own, lengths, block)) == brute(convs)


def test_no_conversation_no_node(spark):
    assert query(spark.createDataFrame([], SCHEMA)).count() == 0
    assert query(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
