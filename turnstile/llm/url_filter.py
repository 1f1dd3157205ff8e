"""URL verdicts: host rules, and a list of URLs behind a blocked Bloom filter.

The listed canonical URLs set bits in a filter of 256-bit blocks; a URL looks at
one block only. URLs whose bits are all set go on to an exact hash join with the
list, which removes the false positives; all others are settled without a
shuffle. The filter is a table of its non-empty blocks. Their number is a
parameter with an upper bound, so that the filter may be broadcast; a list too
long for it lets more URLs through to the join and changes no verdict.

Defined results: a NULL URL, or one without ``://``, has an empty host and path,
fits no rule and is not listed: allow. Repeated rows get the same verdict. An
empty list blocks nothing. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.texts import lower_ascii, whole
from turnstile.session import scratch_path

WORDS_PER_BLOCK = 4  # of 64 bits
BITS_PER_WORD = 2  # set for each URL in each word of its block
KEYS_PER_BLOCK = 12  # about 21 bits per listed URL
MOST_BLOCKS = 1 << 18  # 8 MB of bits: the bound of what is broadcast

HOST = r"://([^/?#]*)"
PATH = r"://[^/?#]*([^?#]*)"
TRACKING = r"[?&](utm_[a-z]+|ref|fbclid|gclid)=[^&#]*"


@dataclass(frozen=True)
class Rule:
    """Verdict for a host with all its subdomains, where the path starts so."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash, in lower case."""
    return lower_ascii(F.regexp_extract(whole(url), r"(?s)^.*?" + HOST, 1))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash."""
    return F.regexp_extract(whole(url), r"(?s)^.*?" + PATH, 1)


def canonical(url: Column) -> Column:
    """One spelling per address: no scheme, fragment, tracking parameter, index file end or final slash."""
    query = F.regexp_extract(whole(url), r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), r"^&", "?")
    path = F.regexp_replace(path_of(url), r"(\.html?|/+)$", "")
    return F.concat(F.regexp_replace(host_of(url), r":(80|443)$", ""), path, query)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(text, verdict) of the longest rule that fits; NULL where none does."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # a longer one, later, overrides
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """The bits of a URL in each word of its block, from one more hash: six of its bits choose one."""
    spread = F.xxhash64(F.lit("bits"), key)
    masks = []
    for word in range(WORDS_PER_BLOCK):
        mask = F.lit(0).cast("long")
        for bit in range(BITS_PER_WORD):
            chosen = F.shiftrightunsigned(spread, 6 * (word * BITS_PER_WORD + bit)).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), chosen))
        masks.append(mask)
    return masks


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """The non-empty blocks for the keys of ``listed`` (key): block and its words."""
    words = [m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("key")))]
    bits = listed.select(_block(F.col("key"), blocks).alias("block"), *words)
    return bits.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS_PER_BLOCK)))


def listed_urls(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """``pages`` (with column key) and, beside each row, whether its key is in ``listed`` (key)."""
    spark = pages.sparkSession
    path = scratch_path(spark, "listed")
    listed.select("key").where("key is not null").distinct().write.parquet(path)
    listed = spark.read.parquet(path)
    blocks = min(MOST_BLOCKS, max(64, listed.count() // KEYS_PER_BLOCK + 1))
    bits = F.broadcast(bloom_filter(listed, blocks))  # at most MOST_BLOCKS rows of 36 bytes
    looked = pages.withColumn("block", _block(F.col("key"), blocks)).join(bits, "block", "left")
    hit = F.lit(True)
    for i, mask in enumerate(_masks(F.col("key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    looked = looked.withColumn("maybe", F.coalesce(hit, F.lit(False)))
    names = pages.columns
    possible = looked.where("maybe").select(*names).hint("shuffle_hash")
    exact = listed.select(F.col("key").alias("_key"), F.lit(True).alias("_listed")).hint("shuffle_hash")
    sure = possible.join(exact, F.col("key") == F.col("_key"), "left")
    return sure.select(*names, F.coalesce("_listed", F.lit(False)).alias("listed")).unionAll(
        looked.where("not maybe").select(*names, F.lit(False).alias("listed"))
    )


def judged(pages: DataFrame, rules: list[Rule], listed: DataFrame) -> DataFrame:
    """Verdict on every page URL: the longest fitting rule's, else block if listed.

    ``listed`` has canonical URLs in column key.
    """
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("key"))
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return listed_urls(rows, listed).withColumn("_rule", rule).select(
        "page_id",
        "host",
        "path",
        F.col("_rule.text").alias("rule"),
        F.coalesce("_rule.verdict", by_list).alias("verdict"),
        "listed",
    )
