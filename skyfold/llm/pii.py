"""Operator 4: personal data, and information-theoretic sanitisation of terms that disclose it.

Base spans come from four patterns. Every matched string is a protected entity. How strongly a term reveals an
entity is estimated from co-occurrence over the corpus, after the sanitisation model of published work on
C-sanitised text: with counts over all different texts, N in all,

    information(entity)   = log(N / texts with the entity)
    shared(entity; term)  = log(N * share / texts with the entity)
    share                 = (texts with both + prior * texts with the entity / N) / (texts with the term + prior)

and a term discloses the entity if shared / information reaches a threshold. The share is smoothed by `prior`
texts in which the two meet by chance alone, so a term seen once counts for less than one seen often with its
entity, but no number of texts is asked for. All four numbers count a text once, however many copies it has, and
look at the whole text: a term stands with every entity of its text, near or far. Wherever a disclosing term stands
in a text of its entity outside the base spans, it becomes a span of kind `term`; documents without personal data
have no entities and stay as they are.

The share is at most (the lesser of the counts of entity and term + ...) / (texts with the term + prior), so a term
on more than some number of texts cannot disclose an entity. Terms over the bound of all entities of their text go
before pairs are made; the bound loses none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import bounded_broadcast, columns_of, text_key, written

#: Broadcast at most so many terms, or terms with their entities; more are joined by a shuffle.
BROADCAST_TERMS = 200_000

KINDS = ("email", "ip", "card", "phone")
FOUND = "doc_id long, key struct<a: long, b: long>, n_email long, n_ip long, n_card long, n_phone long, base array<struct<kind: string, start: long, stop: long>>, entities array<string>, body string"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_NOT_DIGIT = re.compile("[^0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each @ looks back over its local part, so time is linear in the text."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((begin, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d - 9 if (d := 2 * int(c)) > 9 else d for c in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) in code points, by kind and start."""
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p) <= 255 for p in (x.lstrip("0")[:4] or "0" for x in m[0].split(".")))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


def entities(text: str | None, spans: list[tuple[str, int, int]]) -> list[str]:
    """The different protected entities of a text's spans."""
    return sorted({f"{kind}:{text[a:b].lower()}" for kind, a, b in spans})


def terms_of(text: str) -> set[str]:
    """The different words of a text in lower case."""
    return {w.lower() for w in set(_TERM.findall(text))}


def find_base(docs: DataFrame) -> DataFrame:
    """One row a document: its key, the counts and spans of the base patterns, its entities and, with any, its text."""
    kinds = [pa.int64(), pa.struct([("a", pa.int64()), ("b", pa.int64())]), *[pa.int64()] * 4]
    kinds += [pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))]
    kinds += [pa.list_(pa.string()), pa.string()]
    names = ["doc_id", "key", "n_email", "n_ip", "n_card", "n_phone", "base", "entities", "body"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                spans = base_spans(text or "")
                n = Counter(s[0] for s in spans)
                out.append((doc_id, key, *[n[k] for k in KINDS], [dict(zip(("kind", "start", "stop"), s, strict=True)) for s in spans], entities(text, spans), text if spans else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return columns_of(docs).select("doc_id", text_key().alias("key"), "text").mapInArrow(rows, FOUND)


def different_texts(docs: DataFrame, keys: DataFrame, bits: int = 1 << 23) -> DataFrame:
    """(text): each text once. keys: a, b and n, the rows of each text.

    A bit map of the texts with copies, of bounded size, says which texts may have some: those alone are shuffled to
    meet their copies, where a text that is there by chance meets none. The others are taken as they come.
    """
    word, mask = "shiftright(pmod(a, {0}L), 6)", "shiftleft(1L, cast(pmod(a, 64) as int))"
    marks = keys.where("n > 1").groupBy(F.expr(word.format(bits)).alias("_word")).agg(F.expr(f"bit_or({mask})").alias("_marks"))
    own = columns_of(docs).where("text is not null").select(text_key().alias("key"), "text").select("key.a", "key.b", "text")
    probed = own.withColumn("_word", F.expr(word.format(bits))).join(F.broadcast(marks), "_word", "left")
    copied = F.coalesce(F.expr(f"(_marks & {mask}) != 0"), F.lit(False))
    return probed.where(~copied).select("text").unionByName(probed.where(copied).groupBy("a", "b").agg(F.first("text").alias("text")).select("text"))


def term_counts(texts: DataFrame) -> DataFrame:
    """In how many texts each term stands: counted within each batch first, then added up."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["term", "n"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    held.update(terms_of(text))
                    if len(held) > 500_000:
                        yield out()
        if held:
            yield out()

    return texts.select("text").mapInArrow(rows, "term string, n long")


def text_terms(texts: DataFrame) -> DataFrame:
    """(key, term) of the different words of each text (key, body)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                terms = sorted(terms_of(batch.column("body")[k].as_py()))
                if terms:
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column("key")[k].as_py()] * len(terms), batch.column("key").type), pa.array(terms, pa.string())], names=["key", "term"])

    return texts.select("key", "body").mapInArrow(rows, "key struct<a: long, b: long>, term string")


def disclosing(docs: DataFrame, found: DataFrame, threshold: float, prior: float) -> DataFrame:
    """(key, terms): the terms of each text that give one of its entities away, from counts over all different texts."""
    some = written(found.where(F.size("entities") > 0).groupBy("key").agg(F.first("entities").alias("entities"), F.first("body").alias("body")), "texts")
    rows = columns_of(docs).where("text is not null").select(text_key().alias("key")).select("key.a", "key.b")
    keys = written(rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "keys")
    total = F.lit(float(max(keys.count(), 1)))
    held = some.select("key", F.explode("entities").alias("entity"))
    per_entity = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    # shared / information >= threshold says share >= (n_entity / N) ** (1 - threshold), where n_both <= n_entity
    p = F.col("n_entity") / total
    most = (F.col("n_entity") + prior * p) / F.pow(p, F.lit(1 - threshold)) - prior
    held = held.join(per_entity.withColumn("most", most * (1 + 1e-9)), "entity")
    # entities of one text alone stand with the same terms equally often: one of them speaks for all of the text's
    alone = held.where("n_entity = 1").groupBy("key").agg(F.min("entity").alias("entity"), F.first("n_entity").alias("n_entity"), F.first("most").alias("most"))
    held = written(alone.unionByName(held.where("n_entity > 1")), "entities")
    most_of_all = held.agg(F.max("most")).head()[0] or 0.0
    own = text_terms(some)
    per_term = term_counts(different_texts(docs, keys)).join(own.select("term").distinct(), "term", "left_semi")
    per_term = written(per_term.groupBy("term").agg(F.sum("n").alias("n_term")).where(F.col("n_term") <= most_of_all), "terms")
    pairs = written(own.join(bounded_broadcast(per_term, BROADCAST_TERMS), "term").join(held, "key").where(F.col("n_term") <= F.col("most")).select("key", "entity", "term", "n_entity", "n_term"), "pairs")
    both = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term"))
    share = (F.col("n_both") + prior * p) / (F.col("n_term") + prior)
    information = F.log(F.greatest(total / F.col("n_entity"), F.lit(1.0 + 1e-9)))
    scored = both.withColumn("disclosure", F.log(total * share / F.col("n_entity")) / information).where(F.col("disclosure") >= threshold)
    given_away = written(scored.select("entity", "term"), "disclosing")
    # an address in the footer of very many pages is one key: broadcast, or split by the adaptive skew join
    return pairs.join(bounded_broadcast(given_away, BROADCAST_TERMS), ["entity", "term"], "left_semi").groupBy("key").agg(F.collect_set("term").alias("terms"))


def term_spans(text: str, base: list[tuple[int, int]], terms: set[str]) -> list[tuple[int, int]]:
    """Where the terms stand in a text outside its base spans, by start."""
    covered, reach, at, found = sorted(base), -1, 0, []
    for m in _TERM.finditer(text):
        while at < len(covered) and covered[at][0] < m.end():
            reach = max(reach, covered[at][1])
            at += 1
        if reach <= m.start() and m[0].lower() in terms:
            found.append(m.span())
    return found


def find_pii(docs: DataFrame, threshold: float = 0.8, prior: float = 2.0) -> DataFrame:
    """One row a document: doc_id, key, the base counts, base spans and all spans as arrays of (kind, start, stop).

    A null or empty text has no spans. Repeated rows have the same spans, and one with them the row count of docs
    is kept; an empty table gives no rows; other columns are not looked at. Spans of kind `term` follow the base
    ones and don't overlap them.
    """
    found = written(find_base(docs), "spans")
    t = disclosing(docs, found, threshold, prior).withColumnRenamed("key", "_key")
    joined = found.join(t, F.col("key") == F.col("_key"), "left")

    @F.pandas_udf("array<struct<kind: string, start: long, stop: long>>")
    def placed(bodies, bases, terms):
        out = []
        for body, base, own in zip(bodies, bases, terms, strict=True):
            spans = term_spans(body, [(s["start"], s["stop"]) for s in base], set(own)) if own is not None else []
            out.append([{"kind": "term", "start": a, "stop": b} for a, b in spans])
        return bodies.__class__(out)

    return joined.select("doc_id", "key", "n_email", "n_ip", "n_card", "n_phone", "base", F.concat("base", placed("body", "base", "terms")).alias("spans"))


def _joined(spans: str) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)))


def pii_digest(found: DataFrame) -> DataFrame:
    """doc_id, the counts, base_sha256 and spans as text, from find_pii."""
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


#: What takes the place of a span of each kind; a disclosing term is generalised to its class.
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}


def sanitise(docs: DataFrame, found: DataFrame, placeholders: dict[str, str] = PLACEHOLDERS) -> DataFrame:
    """docs with every span of its text generalised to its placeholder ('' removes it); all columns and rows stay,
    whatever the names of other columns.

    Texts without spans, null ones too, are as before; an empty table gives no rows. Where spans overlap, the one that begins first is replaced
    and what others reach beyond it goes with it.
    """

    @F.pandas_udf("string")
    def replaced(texts, spans):
        out = []
        for text, own in zip(texts, spans, strict=True):
            if own is None:
                out.append(text)
                continue
            parts, at = [], 0
            for s in sorted(own, key=lambda s: (s["start"], -s["stop"])):
                if s["start"] >= at:
                    parts += [text[at : s["start"]], placeholders[s["kind"]]]
                at = max(at, s["stop"])
            out.append("".join(parts) + text[at:])
        return texts.__class__(out)

    spans = found.where(F.size("spans") > 0).select(F.col("doc_id").alias("found_doc"), F.col("key").alias("found_key"), "spans").dropDuplicates(["found_doc", "found_key"])
    rows = docs.select(F.struct("*").alias("row"), text_key().alias("key"))
    joined = rows.join(spans, F.col("row.doc_id").cast("long").eqNullSafe(F.col("found_doc")) & (F.col("key") == F.col("found_key")), "left")
    return joined.select(*[(replaced(F.col("row.text").cast("string"), "spans") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
