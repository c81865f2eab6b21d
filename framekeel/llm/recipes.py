"""Exact deduplication by recipes of content-defined chunks.

A text is cut where its own content says so, behind a space that follows one of a few characters, at least
``MIN_CHUNK`` code points apart. Equal texts are cut alike, so a text is the ordered list of its chunks'
identifiers, its recipe, and documents are compared by recipe: a long text moves as eight bytes a chunk.

An identifier is a chunk's 64-bit hash and a number among the different chunks with that hash. The number is
verified on content: chunks of documents that share hashes are grouped by hash and content, each distinct one
once a task, and a hash with several contents gives them different numbers.

Null texts count as empty, and empty texts are equal. Repeated rows are copies of each other; of rows with one
``doc_id`` and text one stays. A null ``doc_id`` stays only if its group has no other. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import per_key
from .common import as_often, keyed, row_key, scratch, staged, text_of

MIN_CHUNK = 256
MAX_CHUNK = 4096


#: White space that is not one plain space already.
_UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
_NUMBERS = "array<struct<place:int,number:int>>"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(text, _UNEVEN, " ")


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text's chunks in order; joined, they give the text."""
    pattern = f"(?s).{{{least},{most}}}?[aeghlnrstz.] |.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _cut(docs: DataFrame, hash_chunk: Callable[[Column], Column]) -> DataFrame:
    cut = docs.withColumn("text", normalised(text_of()))
    cut = cut.withColumn("chunks", chunks(F.col("text")))
    cut = cut.withColumn("hashes", F.transform("chunks", lambda c: hash_chunk(c)))
    return cut.withColumn("recipe_hash", F.xxhash64("hashes"))


def _colliding(contents: DataFrame) -> DataFrame:
    """``hash``, ``chunk`` and ``number`` of the contents whose hash another content has too; usually none."""
    distinct = contents.distinct()
    several = distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    # As many contents as share a 64-bit hash: a handful.
    numbered_chunks = distinct.join(several, "hash").groupBy("hash").agg(F.array_sort(F.collect_set("chunk")).alias("c"))
    return numbered_chunks.select("hash", F.posexplode("c").alias("number", "chunk")).where("number > 0")


def recipes(
    docs: DataFrame, key: Column | None = None, hash_chunk: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """``row_id``, ``key``, ``doc_id``, ``text_sha256``, ``n_chars`` and the verified recipe of every row.

    The recipe is ``hashes`` with ``numbers``, which holds the places whose chunk has a number above zero.
    """
    sha = F.sha2("text", 256).alias("text_sha256")
    n_chars = F.length("text").cast("bigint").alias("n_chars")
    cut = _cut(keyed(docs, "doc_id", "text", key=key), hash_chunk)
    rows = staged(cut.select("row_id", "key", "doc_id", sha, n_chars, "hashes", "recipe_hash"), "recipes")
    # Only documents that share all hashes can be equal; their chunks are verified on content.
    shared = rows.groupBy("recipe_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("recipe_hash")
    rivals = _cut(docs.select("text"), hash_chunk).join(staged(shared, "shared-recipes"), "recipe_hash", "left_semi")
    contents = rivals.select(F.explode("chunks").alias("chunk")).select(hash_chunk(F.col("chunk")).alias("hash"), "chunk")
    colliding = staged(_colliding(contents), "colliding")
    if colliding.isEmpty():
        return rows.withColumn("numbers", F.array().cast(_NUMBERS))
    # Equal digests have equal chunks, so the numbers go by digest.
    places = rivals.select(sha, F.posexplode("chunks").alias("place", "chunk"))
    places = places.withColumn("hash", hash_chunk(F.col("chunk"))).join(colliding, ["hash", "chunk"])
    found = F.array_sort(F.collect_set(F.struct("place", "number"))).cast(_NUMBERS).alias("numbers")
    numbers = per_key(places, ["text_sha256"], found)
    return rows.join(numbers, "text_sha256", "left").withColumn(
        "numbers", F.coalesce("numbers", F.array().cast(_NUMBERS))
    )


def deduplicate(
    docs: DataFrame, key: Column | None = None, hash_chunk: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """Per row of ``docs``: its group's size and the ``doc_id`` that stays, whether the row stays, and its digest."""
    rows = staged(recipes(docs, key, hash_chunk), "verified")
    same = ["n_chars", "hashes", "numbers"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")).alias("first")
    groups = per_key(rows, same, first, F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, same).select(
        "row_id",
        "key",
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("first.row_id") == F.col("row_id")).alias("kept"),
        "text_sha256",
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    with scratch(docs.sparkSession):
        decided = deduplicate(docs, row_key(docs)).select("key", F.col("kept").cast("int").alias("times"))
        return as_often(docs, decided)
