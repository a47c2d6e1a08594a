"""Replacement by a dictionary table: as by a map, with many entries, hot words and odd rows."""

from pyspark.sql import functions as F

from moodmill.functions.normalize import expand_contractions
from moodmill.functions.wordlists import COMMON_CONTRACTIONS
from moodmill.operators import lookup
from moodmill.sources import read_dictionary, read_dictionary_table, write_dictionary, write_dictionary_table

TEXTS = ["we've seen that they'll go", "You're you're YOU'RE", "they'll they'll've", "none here", "", " ", None, "we've\twe've\n"]


def entries(spark, pairs):
    return spark.createDataFrame(pairs, "short string, long string")


def replaced(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_table_gives_what_the_map_gives(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (None, "we've a null key"), (0, "they'll share a key")], "doc_id long, text string")
    chain = {**COMMON_CONTRACTIONS, "go": "go we've", "seen": "they'll"}  # what is put in may be replaced in turn
    table = entries(spark, list(chain.items()))
    by_map = docs.select("doc_id", expand_contractions(F.col("text"), chain).alias("text"))
    assert replaced(lookup.expand_from_table(docs, table)) == replaced(by_map)


def test_a_million_entries_and_a_word_of_every_document(spark):
    million = spark.range(1_000_000).select(
        F.concat(F.lit("w"), "id").alias("short"), F.concat(F.lit("<"), "id", F.lit(">")).alias("long")
    )
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("w7 W7 plain w"), (F.col("id") * 331).cast("string"), F.lit(" w5000000")).alias("text"),
    )
    got = lookup.expand_from_table(docs, million)
    # A word is looked up in lower case and replaced as it is written, also inside other words.
    wanted = F.concat(F.lit("<7> <7> plain "), F.when(F.col("doc_id") * 331 < 1_000_000, F.concat(F.lit("<"), F.col("doc_id") * 331, F.lit(">"))).otherwise(F.concat(F.lit("w"), F.col("doc_id") * 331)), F.lit(" w5000000"))
    starts_with_seven = F.startswith((F.col("doc_id") * 331).cast("string"), F.lit("7"))
    wrong = got.filter(~starts_with_seven & (F.col("text") != wanted))
    assert wrong.count() == 0 and got.count() == 3000


def test_dictionary_files(spark, tmp_path):
    pairs = {"a'b": 'x "y"', "c'd": "e, f", "ü'": "\\ n"}
    one = write_dictionary(spark, str(tmp_path / "one"), pairs)
    many = write_dictionary_table(entries(spark, [*pairs.items()]).repartition(3), str(tmp_path / "many"))
    assert {tuple(r) for r in read_dictionary_table(spark, one).collect()} == set(pairs.items())
    assert {tuple(r) for r in read_dictionary_table(spark, many, lines=True).collect()} == set(pairs.items())
    assert spark.range(1).select(read_dictionary(spark, one).alias("m")).first().m == pairs


def test_plan_holds_no_dictionary_in_a_task(spark):
    docs = spark.createDataFrame([(1, "we've")], "doc_id long, text string")
    found = lookup.found_entries(docs, entries(spark, [("we've", "we have")]), "doc_id", "text")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "Python" not in plan
