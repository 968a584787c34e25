"""Operator 5: benchmark decontamination by a prefix-filtered set join, in DataFrame functions alone.

A window is `size` consecutive words of an item, or the whole of a shorter one. As a set its elements are its
shingles, runs of five words (of a shorter window, all its words). A document contains a window only if it
contains each shingle, so one is a sufficient prefix: the one that is rarest over all documents.

  1. Documents' shingles, as two independent hashes of 64 bits each, meet those of all windows in one pass over the
     texts; a shingle is its 128 bits from there on. What meets, with its place, is written down, and one row a document
     besides: everything after this works on those rows alone, no text is read again and none is shuffled.
  2. Shingles are ordered by how often they stand in all documents. A window with one that never does is dropped.
  3. Each window's prefix shingle, joined with the places, gives candidates; its place in the window and the
     lengths bound where the window could stand.
  4. A candidate holds where shingles that cover its words stand at just those places: its words, A-Z lower-cased, are
     those of the window.

A word of a document inside any occurrence of a window is hit.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import bounded_broadcast, columns_of, text_key, written

#: What is no word character: ASCII other than digits and letters.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 5
#: Broadcast at most so many windows or contaminated documents, and so many shingles; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_SHINGLES = 2_000_000


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased and nothing else; none of null."""
    small = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(small, NO_WORD), "")


def shingles(w: Column, size: int) -> Column:
    """Each run of `size` words, a space between them; null where there are fewer words."""
    places = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size))
    return F.transform(places, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)]))


def hashes(w: Column, size: int) -> Column:
    """128 bits of the `size` words from each place on; of those left at the end, which only a shorter shingle equals."""
    return F.transform(w, lambda x, i: _bits([x, *[F.get(w, i + k) for k in range(1, size)]]))


def _bits(some: list[Column]) -> Column:
    return F.struct(F.xxhash64(*some).alias("a"), F.xxhash64(F.lit(1), *some).alias("b"))


def item_windows(items: DataFrame, size: int = 13, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row a different window: window (array of words) and items (ids of those that have it)."""
    own = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(size - 1), F.lit(1)))
    each = own.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), F.lit(size)).alias("window"))
    return each.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def window_shingles(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """(window, m, t, at, shingle): m words in the window, t in its shingles, at a shingle's place."""
    per_size = [windows.where(F.least(F.size("window"), F.lit(SHINGLE)) == t).select("window", F.size("window").alias("m"), F.lit(t).alias("t"), F.posexplode(shingles(F.col("window"), t)).alias("at", "shingle")) for t in sizes]
    return reduce(DataFrame.unionByName, per_size)


def vocabulary_of(placed: DataFrame, sizes: list[int]) -> DataFrame:
    """(id, shingle, t, hash) of each different shingle of t words."""
    w = F.split("shingle", " ")
    found = F.lit(None).cast("struct<a: bigint, b: bigint>")
    for t in sizes:
        found = F.when(F.col("t") == t, _bits([F.get(w, F.lit(k)) for k in range(t)])).otherwise(found)
    return placed.select("shingle", "t").distinct().select(F.monotonically_increasing_id().alias("id"), "shingle", "t", found.alias("hash"))


def places(docs: DataFrame, vocabulary: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc, n, pos, shingle): the id of every shingle of the vocabulary in docs (doc and text), n words in the
    document, and a row without shingle for each document.
    """
    w = F.col("w")
    # the hashes of each size one after another, and a null that stands for the document itself
    every = F.concat(*[hashes(w, t) for t in sizes], F.array(F.lit(None).cast("struct<a: bigint, b: bigint>")))
    # a row a word has numbers alone: with the document's words in it, a text would be copied as often as it has words
    own = docs.select("doc", words(F.col("text")).alias("w")).select("doc", "w", F.size("w").alias("n"))
    # outer, though no document is without a row: else Spark asks for the array's size first, and makes it twice
    each = own.select("doc", "n", F.posexplode_outer(every).alias("k", "h")).select("doc", "n", F.when(F.col("h").isNotNull(), F.col("k") % F.greatest("n", F.lit(1))).alias("pos"), F.col("h.a").alias("a"), F.col("h.b").alias("b"))
    known = bounded_broadcast(vocabulary.select(F.col("id").alias("shingle"), F.col("hash.a").alias("a"), F.col("hash.b").alias("b")), BROADCAST_SHINGLES)
    return each.join(known, ["a", "b"], "left").where(F.col("pos").isNull() | F.col("shingle").isNotNull()).select("doc", "n", "pos", "shingle")


def with_prefix(placed: DataFrame, frequency: DataFrame) -> DataFrame:
    """(window, m, shingle, at) of the rarest shingle of each window of which every shingle stands in some document."""
    known = placed.join(frequency, "shingle", "left")
    rarest = F.min(F.struct("n", "shingle", "at")).alias("r")
    return known.groupBy("window", "m").agg(F.bool_and(F.col("n").isNotNull()).alias("all"), rarest).where("all").select("window", "m", "r.shingle", "r.at")


def covering(placed: DataFrame) -> DataFrame:
    """(window, at, shingle, needed): shingles that cover all of a window's words, and how many they are."""
    cover = placed.where((F.col("at") % F.col("t") == 0) | (F.col("at") + F.col("t") == F.col("m")))
    return cover.select("window", "at", "shingle", F.ceil(F.col("m") / F.col("t")).alias("needed"))


def occurrences(found: DataFrame, placed: DataFrame) -> DataFrame:
    """(doc, window, start, m) of each place where a window of `placed` stands. found: rows of places()."""
    frequency = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    prefixes = written(with_prefix(placed, frequency), "prefixes")
    start = F.col("pos") - F.col("at")
    candidates = found.join(bounded_broadcast(prefixes, BROADCAST_ROWS), "shingle").where((start >= 0) & (start + F.col("m") <= F.col("n")))
    candidates = candidates.select("doc", "window", start.alias("start"), "m")
    asked = candidates.join(bounded_broadcast(covering(placed), BROADCAST_ROWS), "window").withColumn("pos", F.col("start") + F.col("at"))
    there = asked.join(found.select("doc", "pos", "shingle"), ["doc", "pos", "shingle"], "left_semi")
    # repeated documents ask twice for the same place
    met = there.groupBy("doc", "window", "start", "m").agg(F.size(F.collect_set("at")).alias("met"), F.first("needed").alias("needed"))
    return met.where("met = needed").select("doc", "window", "start", "m")


def find_contamination(docs: DataFrame, items: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """One row a document: doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated.

    contaminated: any word is hit and `share` times the hit words are at least all words. A null or empty text
    has no words and is clean; so is every document if there are no items, and items without words have no
    window. An item_id that is null counts as one named "null"; ids on several rows count once. Repeated
    documents are judged alike, an empty table gives no rows, and other columns are not looked at.
    """
    own = columns_of(docs).select("doc_id", text_key().alias("key"), "text")
    own = own.withColumn("doc", F.struct("doc_id", "key"))  # structs with nulls in them meet in joins
    windows = item_windows(items, size).withColumn("window_id", F.monotonically_increasing_id())
    windows = written(windows, "windows")
    sizes = [r.t for r in windows.select(F.least(F.size("window"), F.lit(SHINGLE)).alias("t")).distinct().collect()] or [SHINGLE]  # SHINGLE numbers at most
    placed = window_shingles(windows, sizes).join(windows.select("window", "window_id"), "window").drop("window").withColumnRenamed("window_id", "window")
    vocabulary = written(vocabulary_of(placed, sizes), "vocabulary")
    placed = written(placed.join(vocabulary.select("id", "shingle", "t"), ["shingle", "t"]).drop("shingle").withColumnRenamed("id", "shingle"), "shingles")
    rows = written(places(own, vocabulary, sizes), "places")
    found = rows.where("shingle is not null")
    hits = occurrences(found, placed).join(bounded_broadcast(windows.select(F.col("window_id").alias("window"), "items"), BROADCAST_ROWS), "window")
    per_doc = hits.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("m")).alias("stop")))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("names"))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit"))
    covered = F.aggregate("spans", none, lambda a, s: F.struct(F.greatest(a["end"], s.stop).alias("end"), (a["hit"] + F.greatest(s.stop - F.greatest(s.start, a["end"]), F.lit(0))).alias("hit")), lambda a: a["hit"])
    judged = written(per_doc.select("doc", covered.alias("hit"), "names"), "hits")
    all_docs = rows.where("shingle is null").select("doc", F.col("n").cast("long").alias("n_words"))
    joined = all_docs.join(bounded_broadcast(judged, BROADCAST_ROWS), "doc", "left")
    n_hit, names = F.coalesce("hit", F.lit(0)).cast("long"), F.coalesce("names", F.array().cast("array<string>"))
    return joined.select(
        "doc.doc_id",
        "doc.key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (F.lit(share) * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of docs that find_contamination() doesn't call contaminated, with all columns, whatever their names.

    Null texts and null doc_ids stay or go by their own judgement; repeated rows go together; an empty table gives no
    rows.
    """
    bad = written(found.where("contaminated").select(F.col("doc_id").alias("bad_doc"), F.col("key").alias("bad_key")).distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), text_key().alias("key"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("bad_doc")) & (F.col("key") == F.col("bad_key"))
    return rows.join(bounded_broadcast(bad, BROADCAST_ROWS), same, "left_anti").select("row.*")


#: DuckDB's statement of the contract, window by window, for find_contamination without its key.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), spread AS (
  SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS win FROM spread
), sizes AS (SELECT DISTINCT k FROM windows
), places AS (
  SELECT row, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k
), grams AS (
  SELECT row, k, s, array_to_string(w[s:s + k - 1], ' ') AS win FROM places
), hits AS (
  SELECT row, grams.k AS k, s, item FROM grams JOIN windows ON grams.win = windows.win AND grams.k = windows.k
), covered AS (
  SELECT row, count(DISTINCT pos) AS n_hit FROM (SELECT row, unnest(range(s, s + k)) AS pos FROM hits) GROUP BY row
), named AS (
  SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""
