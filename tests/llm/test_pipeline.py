import struct

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from stationdw.llm import langid, mixing, pii, simhash
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import docs
from tests.test_entry import canonical


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output over sf0.001, written and read again."""
    path = tmp_path_factory.mktemp("pipeline")
    at, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, at, SF_SMALL).write.parquet(f"{path}/{name}")
        done = spark.read.parquet(f"{path}/{name}")
        out[name] = (at.toPandas(), done.toPandas())
        at = done
    return out


def test_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert list(after.columns) == corpus_pipeline.COLUMNS, name


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages["language_id"]
    gone = before[~before.doc_id.isin(after.doc_id)]
    assert len(gone) <= 0.02 * len(before)
    letters = [langid.letters(t) is not None for t in after.text]
    assert all(letters)


def test_near_dedup_keeps_the_first_of_each_group(stages):
    from tests.llm.test_simhash import slow_components, slow_print
    before, after = stages["simhash_near_dedup"]
    groups = slow_components([(i, slow_print(t)) for i, t in zip(before.doc_id, before.text)])
    assert sorted(after.doc_id) == sorted({c for _, c in groups})
    assert len(after) < len(before)


def test_surrogates(stages):
    before, after = stages["pii_surrogates"]
    assert sorted(before.doc_id) == sorted(after.doc_id)
    new = dict(zip(after.doc_id, after.text))
    for i, t in zip(before.doc_id, before.text):
        assert (new[i] == t) == (not pii.find(t))
    assert all(n == len(t) for n, t in zip(after.n_chars, after.text)
               if pii.find(t))


def test_mix(spark, stages):
    before, after = stages["source_mix"]
    copies = after.doc_id.value_counts()
    assert copies.max() <= 2 and set(after.doc_id) <= set(before.doc_id)
    size = dict(zip(before.doc_id, (len(t.encode().split()) for t in before.text)))
    # some 14 documents a source leave no exact fit everywhere
    assert sum(size[i] for i in after.doc_id) == pytest.approx(1.5 * sum(size.values()), rel=0.01)


def test_tokens(stages):
    before, after = stages["bpe_tokens"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids
           for i, t in zip(before.doc_id, before.text)}
    assert sorted(before.doc_id) == sorted(after.doc_id)
    for i, got, n, decoded in zip(after.doc_id, after.ids, after.n_tokens, after.decoded):
        assert list(got) == ids[i] and n == len(got)
        assert decoded == library.decode(ids[i], skip_special_tokens=False)
        struct.pack(f"<{n}I", *got)


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    assert sorted(got.doc_id) == sorted(stages["bpe_tokens"][1].doc_id)


def test_awkward_rows_pass_every_stage(spark):
    d = docs(spark)
    for name, step in corpus_pipeline.STAGES:
        got = step(spark, d, "")
        assert got.count() >= 0, name
        assert step(spark, docs(spark, []), "").count() == 0, name


@pytest.mark.parametrize("name", sorted(entry._training_data()[1]))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_ORACLE)
    res = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(cols, res.fetchall())


def test_one_query_an_operator():
    names = entry._training_data()[0]
    assert len(names) == 14 and "pipeline" in names
    assert {n.split("_")[0] for n in names} == {"pipeline", *(f"op{i}" for i in range(1, 14))}


def test_mix_and_dedup_are_the_operators():
    assert corpus_pipeline.mixing is mixing and corpus_pipeline.simhash is simhash
