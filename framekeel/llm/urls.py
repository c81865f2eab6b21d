"""Verdicts on URLs: prefix rules first, then a list of canonical URLs behind a blocked Bloom filter.

The filter has one row per block of four 64-bit words. A URL's hash names its block and two bits in each word, so
a lookup meets a single row. URLs whose bits are all set may be listed and go to an exact join with the list,
which removes the false positives; the others, nearly all in practice, move no further. The filter takes
``BITS`` bits a listed URL; up to ``BROADCAST_BYTES`` it is broadcast, beyond that joined by block.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is never listed. Repeated rows
and ties are judged alike, row by row; other columns are not read. An empty list blocks nothing, and an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

BITS = 16
WORDS = 4
BROADCAST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
#: Query fields that say where a visitor came from.
_TRACKING = r"^(utm_[^=]*|ref)(=|$)"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without closing slashes, and the sorted query without tracking fields."""
    fields = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 3), "&")
    kept = F.array_sort(F.filter(fields, lambda x: (x != "") & ~x.rlike(_TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    host, path = F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", "")
    return F.concat(host, path, query)


def rule_of(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        own = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(rule.fits(host, path), own).otherwise(chosen)
    return chosen


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks)).alias("block")


def _masks(url: Column) -> list[Column]:
    """Two bits in each word of a block."""
    bits = F.xxhash64(url, F.lit("bits"))
    one = F.lit(1).cast("bigint")

    def bit(k: int) -> Column:
        place = F.shiftrightunsigned(bits, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    return [bit(2 * k).bitwiseOR(bit(2 * k + 1)).alias(f"mask{k}") for k in range(WORDS)]


def bloom_filter(listed: DataFrame) -> tuple[DataFrame, int]:
    """The filter of the distinct column ``canonical`` as rows of a block and its words, and its blocks' number."""
    n_blocks = max(1, -(-listed.count() * BITS // (64 * WORDS)))
    masks = listed.select(_block(F.col("canonical"), n_blocks), *_masks(F.col("canonical")))
    words = [F.bit_or(f"mask{k}").alias(f"word{k}") for k in range(WORDS)]
    return staged(masks.groupBy("block").agg(*words), "bloom"), n_blocks


def possible_hits(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """``rows`` with ``may``, whether the filter of ``listed`` passes their ``canonical``, written."""
    words, n_blocks = bloom_filter(listed)
    if n_blocks * 8 * (WORDS + 1) <= BROADCAST_BYTES:
        words = F.broadcast(words)
    masks = _masks(F.col("canonical"))
    probe = rows.select("*", _block(F.col("canonical"), n_blocks), *masks).join(words, "block", "left")
    may = F.lit(True)
    for k in range(WORDS):
        may = may & (F.col(f"word{k}").bitwiseAND(F.col(f"mask{k}")) == F.col(f"mask{k}"))
    return staged(probe.select(*rows.columns, F.coalesce(may, F.lit(False)).alias("may")), "probed")


def listed_rows(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """``rows`` with whether their ``canonical`` is in ``listed``, as ``listed``; ``canonical`` may be null."""
    listed = staged(listed.select("canonical").where("canonical <> ''").distinct(), "listed")
    probed = possible_hits(rows, listed)
    found = listed.withColumn("listed", F.lit(True))
    hits = probed.where("may").join(found, "canonical", "left")
    hits = hits.select(*rows.columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    return hits.unionByName(probed.where("NOT may").select(*rows.columns, F.lit(False).alias("listed")))


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page; ``listed`` has ``canonical``."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rows = rows.withColumn("ruled", rule_of(rules, F.col("host"), F.col("path")))
    judged = listed_rows(rows, listed)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", own).alias("verdict")
    )
