import re

import duckdb
import pytest
from pyspark.sql import functions as F

from skyfold.llm import decontamination
from skyfold.llm.decontamination import ORACLE, find_contamination, keep_clean

PASSAGE = "the quick brown fox jumps over the lazy dog while seven small birds sing loudly in the old oak tree today"
ITEMS = [(1, PASSAGE), (2, "Short ITEM"), (3, None), (4, ""), (5, "ÉCOLE fermée"), (None, "nameless piece"), (2, "other words of item two"), (7, PASSAGE), (8, "the"), (9, "...")]
TEXTS = {
    1: f"before {PASSAGE.upper()} after",
    2: None,
    3: "",
    4: "short item, short item! short",
    5: "école fermée",
    6: "ÉCOLE fermée",
    7: " ".join(PASSAGE.split()[3:16]) + " " + " ".join(PASSAGE.split()[3:15]),
    8: " ".join(PASSAGE.split()[:12]),
    9: "the " * 3000 + PASSAGE + " x" * 100,
    10: "nameless piece of other words of item two",
    11: "!!! --- ???",
    12: "clean words only " * 50,
}


@pytest.mark.parametrize("items", [ITEMS, []])
def test_against_duckdb(spark, make_docs, items):
    docs = make_docs([*TEXTS.items(), (1, TEXTS[1]), (1, "a second text of the same id"), (None, PASSAGE)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(docs, bench).drop("key")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", bench.toPandas().astype({"item_id": "Int64"}))
    expected = con.sql(ORACLE).fetchall()
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    if items:
        flags = {r.doc_id: r.contaminated for r in found.collect() if r.doc_id != 1}
        assert flags[7] and not flags[12] and not flags[2]


def test_empty_documents(spark, make_docs):
    assert find_contamination(make_docs([]), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark, make_docs):
    plan = find_contamination(make_docs(TEXTS), spark.createDataFrame(ITEMS, "item_id long, text string"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))


def test_clashing_columns_and_shuffled_shingles(spark, make_docs, monkeypatch):
    """Extra columns of any name stay, and shingles too many to broadcast are met by a shuffle, with the same rows."""
    docs = make_docs([*TEXTS.items(), (None, PASSAGE), (None, None)]).selectExpr("*", "1 AS _doc", "2 AS _key", "3 AS `key`", "4 AS bad_doc", "5 AS doc", "6 AS `row`", "7 AS contaminated")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = find_contamination(docs, bench)
    kept = keep_clean(docs, found)
    assert kept.columns == docs.columns
    assert sorted((repr(r.doc_id), r.text, *r[5:]) for r in kept.collect() if r.text) == sorted((repr(r.doc_id), TEXTS[r.doc_id], 1, 2, 3, 4, 5, 6, 7) for r in found.collect() if not r.contaminated and r.n_words + (r.doc_id == 11))
    whole = sorted(map(tuple, found.collect()), key=repr)
    monkeypatch.setattr("skyfold.llm.decontamination.BROADCAST_SHINGLES", 0)
    monkeypatch.setattr("skyfold.llm.decontamination.BROADCAST_ROWS", 0)
    assert sorted(map(tuple, find_contamination(docs, bench).collect()), key=repr) == whole


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_long_text_costs_as_its_words(spark, monkeypatch, broadcast):
    """A row a word has numbers alone, whichever way it meets the vocabulary: a text isn't copied as often as it has
    words."""
    if not broadcast:
        monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", 0)
    items = spark.createDataFrame([("i", " ".join(f"b{k}" for k in range(20)))], "item_id string, text string")
    text = " ".join(f"w{k % 977}" for k in range(60_000)) + " " + " ".join(f"b{k}" for k in range(3, 18))
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = find_contamination(table, items).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (60_015, 15, 1, False)
    own = table.select(F.struct("doc_id").alias("doc"), "text")
    vocabulary = decontamination.vocabulary_of(decontamination.window_shingles(decontamination.item_windows(items), [5]), [5])
    plan = decontamination.places(own, vocabulary, [5])._jdf.queryExecution().optimizedPlan().toString()
    found = re.search(r"Generate posexplode\(.*, \[([\d, ]*)\], true, \[k#[^]]*\]", plan)
    assert found[1] == "1"  # of doc, w and n below it, the words go no further
