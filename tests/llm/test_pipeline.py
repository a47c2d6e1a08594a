"""Every stage on its own input, against a brute-force version or its stated rules."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from moodmill.llm import registry
from moodmill.storage import materialise

from test_pairs import slow_components, slow_fingerprint


@pytest.fixture(scope="module")
def stages(spark, small):
    """The documents and what each stage makes of its predecessor's rows."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], small), f"test-{name}"))
    return out


def test_all_queries_are_registered():
    assert {*(f"op{n}" for n in range(1, 14))} == {n.split("_")[0] for n in registry.QUERIES if n != "pipeline"}
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(registry.ORACLE) <= set(registry.QUERIES)


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES][1] == "near_duplicates"
    for after in stages[1:-1]:
        assert after.schema.names == stages[0].schema.names
        assert [f.dataType for f in after.schema] == [f.dataType for f in stages[0].schema]


def test_one_document_of_each_group_stays(stages):
    """Against all pairs of fingerprints of the stage's own input."""
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in stages[1].collect()]
    group = slow_components([fp for _, fp in rows], 4)
    kept = Counter(r.doc_id for r in stages[2].select("doc_id").collect())
    members = {}
    for (key, _), g in zip(rows, group, strict=True):
        members.setdefault(g, []).append(key)
    assert kept == Counter(min(keys) for keys in members.values())
    assert any(len(keys) > 1 for keys in members.values())


def test_secrets_keep_documents(stages):
    assert Counter(r.doc_id for r in stages[3].collect()) == Counter(r.doc_id for r in stages[2].collect())
    old = {r.doc_id: r.text for r in stages[2].collect()}
    for r in stages[3].collect():
        assert r.n_chars == len(r.text)
        assert r.text == old[r.doc_id] or "[secret]" in r.text


def test_mixing_repeats_documents(stages):
    counts = Counter(r.doc_id for r in stages[4].collect())
    assert set(counts) <= {r.doc_id for r in stages[3].collect()} and max(counts.values()) == 2


def test_packing_holds_every_document(stages):
    tokens = Counter(r.doc_id for r in stages[4].collect())
    packed = Counter(r.doc_id for r in stages[5].filter("start = 0").collect())
    assert packed == tokens


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_run_on_odd_and_empty_tables(spark, tmp_path, request, which):
    docs = request.getfixturevalue(which).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r.doc_id for r in rows}
    # What has no words, few words or mostly repeated ones goes; of copies one stays.
    assert kept <= {5, 6, 8, 9, 10, None} and (6 in kept) == (which == "odd")
    starts = Counter(r.doc_id for r in rows if r.start == 0)
    assert all(n <= 2 for key, n in starts.items() if key != 10)


def test_run_equals_the_stages(spark, small, stages):
    got = corpus_pipeline.run(spark, small)
    assert got.columns == stages[5].columns
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(map(tuple, got.select(*key).collect())) == Counter(map(tuple, stages[5].select(*key).collect()))
