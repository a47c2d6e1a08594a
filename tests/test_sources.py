import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from moodmill import storage
from moodmill.functions import normalize
from moodmill.operators import prepare
from moodmill.sources import (
    SENTIMENT_CLASSES,
    bind_positions,
    read_csv,
    read_csv_checked,
    read_dictionary,
    read_runs,
    read_table,
    write_csv,
    write_dictionary,
    write_run,
    write_table,
)
from moodmill.streaming.score import score_stream

NAMES = ["sentiment", "id", "date", "flag", "user", "text"]


def test_csv_round_trip_with_quotes_and_breaks(spark, tmp_path):
    rows = [("1", 'say "hi", ok'), ("2", "two\nlines"), ("3", "back\\slash\\"), ("4", "œ é")]
    df = spark.createDataFrame(rows, "id string, text string")
    path = write_csv(df, str(tmp_path / "t"))
    back = read_csv(spark, path, ["id", "text"], multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_single_line_records_break_and_the_filter_drops_the_rest(spark, tmp_path):
    (tmp_path / "t.csv").write_text('sentiment,text\npositive,"one\ntwo"\nnegative,plain\n,none\n')
    df = read_csv(spark, str(tmp_path / "t.csv"), ["sentiment", "text"])
    assert df.count() == 4
    kept = prepare.keep_labels(df, "sentiment", SENTIMENT_CLASSES).collect()
    assert sorted(r.sentiment for r in kept) == ["negative", "positive"]
    whole = read_csv(spark, str(tmp_path / "t.csv"), ["sentiment", "text"], multi_line=True)
    assert "one\ntwo" in [r.text for r in whole.collect()]


def test_binding_by_position_without_a_header(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes('"4","9","d","q","u","caf\xe9"\n"0","8","d","q","u","x"\n'.encode("latin-1"))
    raw = read_csv(spark, str(tmp_path / "t.csv"), NAMES, header=False, encoding="ISO-8859-1")
    bound = bind_positions(raw, {0: "sentiment", 5: "text"})
    coded = prepare.encode_label(bound, "sentiment", prepare.NUMERIC_LABELS)
    assert sorted(map(tuple, coded.collect())) == [("0", "x", 0), ("4", "café", 2)]


def expanded(spark, dictionary, text):
    rows = spark.createDataFrame([(text,)], "text string").withColumn("d", dictionary)
    return rows.select(normalize.expand_contractions(F.col("text"), F.col("d"))).first()[0]


def test_dictionary(spark, tmp_path):
    entries = {"you're": "you are", "we've": "we have"}
    (tmp_path / "d.json").write_text(json.dumps({"contractions": entries}, indent=1))
    path = str(tmp_path / "d.json")
    dictionary = read_dictionary(spark, path)
    assert spark.range(1).select(dictionary).first()[0] == entries
    assert expanded(spark, dictionary, "Ok we've won, you're late") == "Ok we have won, you are late"


def test_dictionary_of_any_size(spark, tmp_path):
    entries = {f"w{i}": f"long {i}" for i in range(12_000)}
    path = write_dictionary(spark, str(tmp_path / "d"), entries)
    assert expanded(spark, read_dictionary(spark, path), "w11999 w0 x") == "long 11999 long 0 x"


def test_write_table(spark, tmp_path):
    path = write_table(spark.range(3).withColumn("split", F.lit("test")), str(tmp_path / "p"), "overwrite", "split")
    assert spark.read.parquet(path).count() == 3


def test_inputs_move_only_when_asked_to(spark, small):
    def plan():
        return read_table(spark, small, "documents")._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in plan()
    spark.conf.set("spark.moodmill.spreadInputs", "5")
    try:
        assert "RoundRobinPartitioning(5)" in plan()
    finally:
        spark.conf.unset("spark.moodmill.spreadInputs")


class FakeSession:
    """A session with the two settings that decide where tables are stored."""

    def __init__(self, configured, master):
        self.conf = self.sparkContext = self
        self.configured, self.master, self.chosen = configured, master, None

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.configured or default

    def getCheckpointDir(self):  # noqa: N802
        return self.chosen

    def setCheckpointDir(self, folder):  # noqa: N802
        self.chosen = folder


def test_the_named_folder_is_used_and_a_scratch_one_only_locally():
    assert storage.shared_dir(FakeSession("hdfs:///shared", "yarn")) == "hdfs:///shared"
    local = FakeSession(None, "local[4]")
    assert storage.shared_dir(local) == storage.shared_dir(local) == local.chosen
    with pytest.raises(ValueError):
        storage.shared_dir(FakeSession(None, "yarn"))


def test_stored_tables_go_to_that_folder(spark):
    stored = storage.materialise(spark.range(5), "five")
    assert stored.count() == 5
    folder = storage.shared_dir(spark).removeprefix("file:")
    assert any(folder in path for path in stored.inputFiles())


def test_a_scope_leaves_nothing_behind(spark, tmp_path):
    folder = Path(storage.shared_dir(spark).removeprefix("file:")) / "moodmill"
    before = set(folder.glob("*"))
    out = str(tmp_path / "out")
    with storage.removing_tables(spark):
        first = storage.materialise(spark.range(5), "first")
        storage.materialise(first.selectExpr("id * 2 AS id"), "second").write.parquet(out)
        assert len(set(folder.glob("*")) - before) == 2
    assert set(folder.glob("*")) == before
    assert spark.read.parquet(out).count() == 5


def test_stream_batches_are_stored_once(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for text in ("a", "bb"):
        spark.createDataFrame([(text,)], "text string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("text string").parquet(source)
        measure = lambda b: b.select("text", F.length("text").alias("n"))
        score_stream(stream, measure, out, progress).awaitTermination()
    assert sorted((r.text, r.n) for r in spark.read.parquet(out).collect()) == [("a", 1), ("bb", 2)]


def test_checked_csv_loses_no_line(spark, tmp_path):
    lines = ["id,word,n", "1,a,5", "2,b", "x,c,7", "3,,8", "4,d,9,10", '5,"e,f",1', '6,"open,2', "7,g,3.5", "", "8,h,"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    good, broken = read_csv_checked(spark, str(tmp_path / "in.csv"), {"id": "bigint", "word": "string", "n": "int"}, ["word"])
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a", 5), (5, "e,f", 1), (8, "h", None)]
    found = {r.record: r.reason for r in broken.collect()}
    assert found == {
        "2,b": "columns",
        "x,c,7": "type of id",
        "3,,8": "missing word",
        "4,d,9,10": "columns",
        '6,"open,2': "columns",
        "7,g,3.5": "type of n",
    }
    assert all(r.file.endswith("in.csv") for r in broken.collect())


def test_checked_csv_without_lines(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n")
    good, broken = read_csv_checked(spark, str(tmp_path / "in.csv"), {"a": "int", "b": "string"})
    assert (good.count(), broken.count()) == (0, 0)


def test_a_repeated_run_replaces_its_rows_only(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = lambda *pairs: spark.createDataFrame(pairs, "k int, part string")
    write_run(rows((1, "a"), (2, "b")), path, "one", "part")
    write_run(rows((3, "a"), (4, "c")), path, "two", "part")
    write_run(rows((5, "a")), path, "two", "part")
    got = sorted((r.run, r.part, r.k) for r in read_runs(spark, path).collect())
    assert got == [("one", "a", 1), ("one", "b", 2), ("two", "a", 5)]
