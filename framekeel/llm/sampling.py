"""Bounded samples of labelled rows for fitting classifiers, and what both classifiers read of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

_CELLS = 1 << 30


def fold(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether the row is held out: crc32 of the id as text leaves ``part`` if divided by ``parts``. A null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def letters(text: Column) -> Column:
    """The text in lower case with a space for each run of other characters than letters and marks, and around it.

    A text without letters, or null, is two spaces.
    """
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")
    return F.when(text.rlike(r"\p{L}"), F.concat(F.lit(" "), F.trim(plain), F.lit(" "))).otherwise("  ")


def per_class(rows: DataFrame, label: str, by: Column, most: int) -> DataFrame:
    """About ``most`` rows of each class at most, picked by a hash of ``by``: those in the lowest cells.

    Rows that agree in label and ``by`` count once, so copies cannot fill the sample. ``_cell`` orders the rows.
    """
    cells = rows.where(F.col(label).isNotNull()).withColumn("_hash", F.xxhash64(by, F.lit("sample")))
    cells = cells.withColumn("_cell", F.pmod("_hash", F.lit(_CELLS)))
    share = F.least(F.lit(1.0), F.lit(float(most)) / F.approx_count_distinct("_hash"))
    # Written, so that Spark knows its size and broadcasts it while it is small.
    limits = staged(cells.groupBy(F.col(label).alias("_label")).agg(share.alias("_share")), "class-limits")
    chosen = cells.join(limits, F.col(label) == F.col("_label"))
    chosen = chosen.where(F.col("_cell") < F.col("_share") * _CELLS).drop("_label", "_share")
    return chosen.dropDuplicates([label, "_hash"]).drop("_hash")


def evenly(sample: DataFrame, label: str, total: int) -> DataFrame:
    """About ``total`` rows of ``per_class``: each class's first, then its second, and so on, one of each class at least."""
    turn = F.row_number().over(Window.partitionBy(label).orderBy("_cell"))
    ranked = staged(sample.withColumn("_turn", turn), "class-turns")
    classes = ranked.where("_turn = 1").count()
    return ranked.orderBy("_turn", "_cell", label).limit(max(total, classes)).drop("_turn")


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``doc_id``, ``label`` and ``text_hash`` of the labelled rows of ``docs`` that have a text, written.

    Of several labels of a document the highest counts; null ids and labels other than 0 and 1 are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).where("label IN (0, 1)")
    texts = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_hash"))
    return staged(texts.join(known, "doc_id"), "labelled")


def texts_of_each_label(docs: DataFrame, labelled: DataFrame, most: int) -> DataFrame:
    """``label``, ``text_hash`` and ``text`` of about ``most`` distinct texts of each label, by ``labelled_texts``.

    Only hashes are sorted out; the texts that were chosen are read last.
    """
    chosen = per_class(labelled.select("doc_id", "label", "text_hash"), "label", F.col("text_hash"), most)
    # About 2 * most rows of three numbers.
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("_doc"), "label", F.col("text_hash").alias("_text")))
    rows = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    rows = rows.join(chosen, (F.col("doc_id") == F.col("_doc")) & (F.col("text_hash") == F.col("_text")))
    return rows.select("label", "text_hash", "text").dropDuplicates(["label", "text_hash"])
