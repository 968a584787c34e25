"""Operator 10: URL rules, and a blocked Bloom filter of listed URLs before an exact join.

Rules name a host, with all its subdomains, and the beginning of a path; the longest one that fits decides.
URLs without a rule are looked up in a list by their canonical form. The Bloom filter has one 64-bit word a
block and sets `bits` of it for each listed URL, so that a look-up reads one word: a broadcast table of blocks.
Its size follows the list's up to a bound: a list that is too long for it lets more false positives through to
the exact hash join, which removes them all, and never changes a verdict. Pages are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.common import fits, written

#: Broadcast at most so many listed URLs; with more of them possible hits are shuffled to meet them.
BROADCAST_URLS = 200_000

# Fixed values: (verdict, host, path) of the production rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(df: DataFrame, url_col: str = "url") -> DataFrame:
    """df with _host and _path of each URL; both empty where it is null or has no ://."""
    url = F.col(url_col)
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    return df.withColumn("_rest", rest).withColumn("_host", F.translate(host, _UPPER, _LOWER)).withColumn("_path", path).drop("_rest")


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule as host and path, verdict) of the longest rule that fits; null where none does."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)) if name is None else name.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if name is None else (name, verdict)


def canonical(host: Column, path: Column) -> Column:
    """One spelling of a URL: no scheme, port 80 or 443, leading www., query, fragment or slash at the end."""
    bare = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    return F.concat(bare, F.regexp_replace(path, r"/+$", ""))


def _marks(url: Column, blocks: int, bits: int) -> tuple[Column, Column]:
    """(block, bits of its word) of a canonical URL."""
    block = F.pmod(F.xxhash64(url), F.lit(blocks))
    second = F.xxhash64(F.lit(1), url)
    mask = F.lit(0).cast("long")
    for k in range(bits):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return block, mask


def bloom_filter(listed: DataFrame, blocks: int, bits: int) -> DataFrame:
    """(block, word): the filter's words that have a bit set, put together by block on the executors."""
    block, mask = _marks(F.col("canonical"), blocks, bits)
    return listed.groupBy(block.alias("block")).agg(F.bit_or(mask).alias("word"))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: tuple = RULES, url_col: str = "url", id_col: str = "page_id", most_blocks: int = 1 << 20, bits: int = 5, salts: int = 16) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict and maybe_listed.

    listed: a column `canonical` as canonical() makes it; nulls and repeats don't matter. A rule's verdict holds;
    without one a listed URL is blocked and any other allowed, so an empty list allows all. A null URL or one
    without :// has an empty host and path, fits no rule and is never listed. Repeated pages are judged alike;
    an empty table gives no rows; other columns are not looked at. most_blocks bounds the filter's words.
    """
    own = split_url(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("_url")), "_url")
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    own = own.withColumn("rule", rule).withColumn("_verdict", verdict)
    own = own.withColumn("_canonical", F.when(F.col("rule").isNull() & (F.col("_host") != ""), canonical(F.col("_host"), F.col("_path"))))
    names = written(listed.where(F.col("canonical").isNotNull()).select("canonical").distinct(), "listed")
    wanted = max(1, names.count() // 4)  # 16 bits a URL while the bound allows
    blocks = min(most_blocks, 1 << (wanted - 1).bit_length())
    block, mask = _marks(F.col("_canonical"), blocks, bits)
    known = F.broadcast(bloom_filter(names, blocks, bits).withColumnRenamed("block", "_block"))
    probed = own.withColumn("_block", F.when(F.col("_canonical").isNotNull(), block)).join(known, "_block", "left")
    hit = F.coalesce(F.col("word").bitwiseAND(mask) == mask, F.lit(False))
    probed = probed.select("page_id", "_url", "_host", "_path", "rule", "_verdict", "_canonical", hit.alias("maybe_listed"))
    right = names.select(F.col("canonical").alias("_key"), F.lit(True).alias("_listed"))
    if fits(names, BROADCAST_URLS):
        key = F.when(F.col("maybe_listed"), F.col("_canonical"))
        judged = probed.withColumn("_key", key).join(F.broadcast(right), "_key", "left")
    else:  # possible hits alone are shuffled; one URL on very many pages is spread by a salt
        probed = written(probed, "probed")
        salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        hits = probed.where("maybe_listed").withColumn("_key", F.col("_canonical")).withColumn("_salt", F.pmod(F.xxhash64("page_id", "_url"), F.lit(salts)).cast("int"))
        judged = hits.join(salted, ["_key", "_salt"], "left").unionByName(probed.where("not maybe_listed"), allowMissingColumns=True)
    final = F.coalesce("_verdict", F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), "rule", final.alias("verdict"), "maybe_listed")


def url_list(spark: SparkSession, hosts: tuple[str, ...], prefixes: tuple[str, ...], sections: tuple[str, ...], numbers: int, suffixes: tuple[str, ...]) -> DataFrame:
    """canonical: a list of URLs by a rule, prefix, host, /section/number and suffix, for want of a published one."""
    each = spark.range(numbers).select(F.col("id").cast("string").alias("n"))
    for name, values in (("host", hosts), ("prefix", prefixes), ("section", sections), ("suffix", suffixes)):
        each = each.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return each.select(F.concat("prefix", "host", F.lit("/"), "section", F.lit("/"), "n", "suffix").alias("canonical"))
