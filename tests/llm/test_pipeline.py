import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from skyfold.llm.quality import counts  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with one case each of what a stage decides, among clean ones."""
    rng = random.Random(11)

    def prose(n):
        return " ".join(f"wort{rng.randrange(3000)}" for _ in range(n)) + "."

    item = prose(40)
    texts = {i: prose(120) for i in range(60)}
    junk = {i: " ".join(f"wort{rng.randrange(3000)}###" for _ in range(80)) for i in range(60, 100)}
    texts |= junk
    texts[100] = "too short"
    texts[101] = "again and again and " * 40
    texts[102], texts[103] = None, ""
    texts[104] = texts[5]
    texts[105] = texts[6].replace(texts[6].split()[60], "changed", 1)
    texts[106] = prose(20) + " " + item + " " + prose(20)
    texts[107] = prose(60) + " mail to jo@corp.example or +49 30 1234567 " + prose(60)
    folder = tmp_path_factory.mktemp("sf")
    own = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    own.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i not in junk), 0) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts, set(junk)


def test_stages(spark, tables, tmp_path):
    folder, texts, junk = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids.append([r.doc_id for r in docs.select("doc_id").collect()])
        if k < len(pipeline.STAGES) - 1:
            assert docs.columns == columns, name
    failed = {i for i, t in texts.items() if (c := counts((t or "").encode()))[0] < 10 or 100 * c[4] > 20 * c[0]}
    assert sorted(ids[0]) == sorted(set(texts) - failed - junk)
    assert sorted(ids[1]) == sorted(set(ids[0]) - {104, 105})
    assert sorted(ids[2]) == sorted(set(ids[1]) - {106})
    assert sorted(ids[3]) == sorted(ids[2])
    clean = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    assert "[EMAIL]" in clean[107].text and "jo@" not in clean[107].text and clean[107].n_chars == len(clean[107].text)
    assert all(clean[i].text == texts[i] for i in ids[3] if i != 107)
    pieces = spark.read.parquet(f"{tmp_path}/4").collect()
    assert {r.doc_id for r in pieces} == set(ids[3])
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in pipeline.run(spark, folder).collect())


def test_empty_tables(spark, tables, tmp_path):
    folder, _, _ = tables
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns(spark, tables, tmp_path):
    """Columns named like those that stages use inside go through all of them as they are."""
    folder, texts, _ = tables
    names = ["kept", "_doc", "_uid", "_key", "_spans", "key", "uid", "doc", "row", "spans", "class_id", "contaminated", "probability", "tie"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in names])
    columns = docs.columns
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            assert all(r[c] == f"{c}{r.doc_id}" for r in docs.collect() for c in names), name
