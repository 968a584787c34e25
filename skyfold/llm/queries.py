"""The numbered queries, with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyfold.llm import decontamination, licenses, merkle, near_dedup, pii, quality, resampling, simhash, url_filter, vector_codes
from skyfold.llm.attribution import section_tokens
from skyfold.llm.common import bounded_broadcast
from skyfold.llm.packing import pack_documents
from skyfold.llm.token_file import token_digest

#: Names of the listed hosts, each under example.org and example.net.
LISTED_NAMES = ("spam-farm", "cheap-pills", "free-bets", "ththhe", "ththth", "thther", "tionble", "tionsh", "tiontion", "ththon")
#: The listed URLs: every /section/number of these hosts, with and without these prefixes and suffixes: 192,000.
LISTED = {
    "hosts": tuple(f"{name}.example.{top}" for name in LISTED_NAMES for top in ("org", "net")),
    "prefixes": ("", "m.", "blog."),
    "sections": ("en", "de", "es", "fr"),
    "numbers": 400,
    "suffixes": ("", ".html"),
}
#: The share of documents that resampling keeps.
KEPT_SHARE = 0.8
#: Broadcast at most so many ids of the resampling target (8 MB); with more of them texts are shuffled to meet them.
BROADCAST_IDS = 1_000_000


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simple8b_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(_table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).drop("uid")


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    good = _table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id").distinct()
    target = docs.join(bounded_broadcast(good, BROADCAST_IDS), "doc_id", "left_semi")
    return resampling.resample(docs, target, share=KEPT_SHARE)


def op4_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.find_pii(_table(spark, sf_dir, "documents")))


def op5_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("key")


def op6_fuzzy_license_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(_table(spark, sf_dir, "documents"))


def op7_quality_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op8_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(_table(spark, sf_dir, "documents"), vocabulary(), rule="largest")


def op9_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary(), budget=2048, end_id=1)


def op10_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, url_filter.url_list(spark, **LISTED)).drop("maybe_listed")


def op11_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_merkle_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_proofs(_table(spark, sf_dir, "documents"))


def op13_yinyang_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.product_codes(_table(spark, sf_dir, "embeddings"))


QUERIES = (
    op1_simple8b_token_file,
    op2_order_minhash,
    op3_importance_resampling,
    op4_disclosure_sanitisation,
    op5_prefix_decontamination,
    op6_fuzzy_license_search,
    op7_quality_regression,
    op8_offset_attribution,
    op9_ordered_packing,
    op10_bloom_url_filter,
    op11_simhash_pigeonhole,
    op12_merkle_store,
    op13_yinyang_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


_URL_ORACLE = r"""
WITH p AS (
  SELECT page_id, url, strpos(coalesce(url, ''), '://') AS place, substr(url, strpos(url, '://') + 3) AS rest FROM pages
), s AS (
  SELECT page_id,
         CASE WHEN place > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN place > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM p
), c AS (
  SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/+$', '') AS canonical FROM s
), listed AS (
  SELECT prefix || listed_name || '.example.' || top || '/' || section || '/' || n || suffix AS canonical FROM range(400) AS numbers(n),
         unnest(['spam-farm', 'cheap-pills', 'free-bets', 'ththhe', 'ththth', 'thther', 'tionble', 'tionsh', 'tiontion', 'ththon']) AS a(listed_name),
         unnest(['org', 'net']) AS d(top),
         unnest(['', 'm.', 'blog.']) AS b(prefix), unnest(['en', 'de', 'es', 'fr']) AS f(section), unnest(['', '.html']) AS g(suffix)
), r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
  END AS rule FROM c
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN host <> '' AND canonical IN (SELECT canonical FROM listed) THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: The CRC-32 of a decimal number, bit by bit: of its digits in turn, eight steps each.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, c: list_reduce(list_prepend(xor(a, c), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))"""
_MERKLE_ORACLE = f"""
WITH RECURSIVE own AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf, coalesce(xor({_CRC}, 4294967295) % 3 = 0, false) AS tampered, {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS low FROM documents
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM own
), node(tree, level, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY tree, level, pos // 8, n
), subroots AS (SELECT tree, h AS subroot, level AS height FROM node WHERE n = 1
), top(level, pos, n, h) AS (
  SELECT 0, tree, count(*) OVER (), subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 8, n
), run AS (
  SELECT tree, level, pos // 8 AS up, list(h ORDER BY pos) AS hs FROM node WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.tree, s.height + t.level, t.pos // 8, t.hs FROM (SELECT level, pos // 8 AS pos8, list(h ORDER BY pos) AS hs, unnest(list(pos)) AS pos FROM top WHERE n > 1 GROUP BY level, pos // 8) t
  JOIN subroots s ON s.tree // CAST(pow(8, t.level) AS BIGINT) = t.pos
), fold(tree, leaf_pos, level, height, pos, h, proof) AS (
  SELECT tree, l.pos, 0, height, CASE WHEN height = 0 THEN tree ELSE l.pos END, CASE WHEN tampered THEN low ELSE leaf END, '' FROM leaves l JOIN subroots USING (tree)
  UNION ALL
  SELECT f.tree, leaf_pos, f.level + 1, height, CASE WHEN f.level + 1 = height THEN f.tree ELSE pos // 8 END,
         sha256(array_to_string(hs[:pos % 8], '') || h || array_to_string(hs[pos % 8 + 2:], '')), proof || array_to_string(hs[:pos % 8], '') || array_to_string(hs[pos % 8 + 2:], '')
  FROM fold f JOIN run r ON r.tree = f.tree AND r.level = f.level AND r.up = f.pos // 8
), ended AS (SELECT tree, leaf_pos, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM fold GROUP BY ALL
), root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN subroots USING (tree) JOIN ended e ON e.tree = l.tree AND e.leaf_pos = l.pos, root
"""


def _codes_oracle(rounds: int = 6) -> str:
    """Plain Lloyd rounds over components, one table a round."""
    near = """a{k} AS MATERIALIZED (
  SELECT id, part, arg_min(entry, {{'d': d, 'e': entry}}) AS entry, min(d) AS d FROM (
    SELECT v.id, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{k} c ON c.part = v.part AND c.place = v.place GROUP BY v.id, v.part, c.entry
  ) GROUP BY id, part
)"""
    moved = """c{n} AS MATERIALIZED (
  SELECT c.part, c.entry, c.place, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN (
    SELECT a.part, a.entry, v.place, CAST((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM a{k} a JOIN v ON v.id = a.id AND v.part = a.part GROUP BY ALL
  ) m ON m.part = c.part AND m.entry = c.entry AND m.place = c.place
)"""
    steps = ",\n".join(near.format(k=k) + (",\n" + moved.format(k=k, n=k + 1) if k < rounds else "") for k in range(rounds + 1))
    return f"""
WITH k AS (SELECT vec_id AS id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT id, unnest(range(len(embedding))) AS nth, len(embedding) // 8 AS width, CAST(floor(4096 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM k),
v AS MATERIALIZED (SELECT id, nth // width AS part, nth % width AS place, x FROM u),
c0 AS MATERIALIZED (SELECT v.part, f.entry, v.place, v.x FROM v JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS entry FROM k ORDER BY id LIMIT 16) f ON f.id = v.id),
{steps},
e AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY id)
SELECT k.id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM c{rounds}) AS codebooks_sha256
FROM k JOIN e ON e.id = k.id
"""


def oracle_sql() -> dict[str, str]:
    return {"op13_yinyang_codes": _codes_oracle(), "op12_merkle_store": _MERKLE_ORACLE, "op5_prefix_decontamination": decontamination.ORACLE, "op10_bloom_url_filter": _URL_ORACLE}
