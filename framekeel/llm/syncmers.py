"""Document fingerprints of closed syncmers.

A text is read as units: words cut into at most ``UNIT`` characters, and single signs and ideographs. Of
every ``K`` units in a row, the runs of ``S`` units inside are hashed; the ``K`` units are kept if the least hash
lies at their first or last run. Whether they are kept depends on nothing outside them, so texts that share a
passage share its anchors, wherever it stands. The fingerprint lists all kept anchors in order of place, as 32-bit
hashes in hexadecimal; ``anchors`` has them with their places, for positional matching.

The likeness of two fingerprints is twice the number of anchors that both have over the sum of the numbers of
anchors they have; an anchor that comes several times counts as often as both have it. Texts of fewer than ``K`` units have one anchor of all their units. A
text without units has an empty fingerprint; two such are alike (1), one and another are not (0).

The next document is found without gathering ids. Documents are dealt to buckets of neighbouring ids, whose bounds
come from a sample of at most ``SAMPLE`` ids; the sample shapes the buckets and not the result. The highest document
of a bucket is also sent, as a guest, to the bucket above, where it follows the lowest, and the highest of all to the
lowest bucket. So each text moves once, and one window per bucket gives every document its next one.

A null text counts as empty. Repeated rows and null ids are documents of their own, in descending order of id, null
last, then by digest. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

K = 5
S = 2
UNIT = 8
#: Code points from U+2E80 on are ideographs and the like, which are units by themselves.
_UNITS = rf"[\p{{L}}\p{{M}}\p{{N}}&&[\x00-\u2E7F]]{{1,{UNIT}}}|[^\x20\x09-\x0D]"

SAMPLE = 1 << 20
#: Documents in a bucket, and most buckets.
BUCKET_ROWS = 256
MAX_BUCKETS = 1 << 16


def _runs(values: Column, width: int) -> Column:
    """Each run of ``width`` values as a struct of ``r0``, ``r1``, ..."""
    n = F.size(values)
    shifted = [F.slice(values, F.lit(k + 1), F.greatest(n - k, F.lit(0))).alias(f"r{k}") for k in range(1, width)]
    zipped = F.arrays_zip(values.alias("r0"), *shifted)
    return F.slice(zipped, F.lit(1), F.greatest(n - (width - 1), F.lit(0)))


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the anchors of column ``text``: structs of ``place`` (of the first unit) and ``hash``, in order."""
    units, inner = f"{name}_units", f"{name}_inner"
    last = K - S
    hashed = F.transform(F.regexp_extract_all(F.col(text), F.lit(_UNITS), F.lit(0)), lambda u: F.xxhash64(u))
    # Three of the inner runs hold all units of the outer one.
    whole = [f"r{k}" for k in sorted({*range(0, last, S), last})]
    at_edge = lambda x: F.least(*(x[f"r{k}"] for k in range(last + 1))).isin(x["r0"], x[f"r{last}"])

    def marked(x: Column, i: Column) -> Column:
        low = F.xxhash64(*(x[r] for r in whole)).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(at_edge(x), F.struct(i.alias("place"), low.alias("hash")))

    kept = F.filter(F.transform(_runs(F.col(inner), last + 1), marked), lambda a: a.isNotNull())
    short = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(F.col(units)).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash")))
    n = F.size(units)
    df = df.withColumn(units, hashed)
    df = df.withColumn(inner, F.transform(_runs(F.col(units), S), lambda x: F.xxhash64(*(x[f"r{k}"] for k in range(S)))))
    found = F.when(n >= K, kept).when(n > 0, short).otherwise(F.array().cast("array<struct<place:int,hash:bigint>>"))
    return df.withColumn(name, found).drop(units, inner)


def fingerprint(anchors: Column) -> Column:
    """The hashes of the anchors, in order, eight digits each."""
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.lower(F.hex(a["hash"])), 8, "0")), "")


def hashes_of(anchors: Column) -> Column:
    return F.transform(anchors, lambda a: a["hash"])


def likeness(a: Column, b: Column) -> Column:
    """Of two lists of hashes: 0 to 1."""
    both = F.size(a) + F.size(b)
    # In order, with the side as the last bit, equal hashes are neighbours and one pass counts what is unmatched.
    sided = F.concat(F.transform(a, lambda h: h * 2), F.transform(b, lambda h: h * 2 + 1))

    def step(state: Column, x: Column) -> Column:
        own, sign = F.shiftright(x, 1), 1 - 2 * (x % 2)
        same = state["hash"] == own
        surplus = F.when(same, state["surplus"] + sign).otherwise(sign)
        unmatched = F.when(same, state["unmatched"]).otherwise(state["unmatched"] + F.abs(state["surplus"]))
        return F.struct(own.alias("hash"), surplus.alias("surplus"), unmatched.alias("unmatched"))

    zero = F.lit(0).cast("bigint")
    start = F.struct(F.lit(-1).cast("bigint").alias("hash"), zero.alias("surplus"), zero.alias("unmatched"))
    unmatched = F.aggregate(F.sort_array(sided), start, step, lambda s: s["unmatched"] + F.abs(s["surplus"]))
    return F.when(both > 0, 1.0 - unmatched / both).otherwise(1.0)


def _bounds(ids: DataFrame) -> list[int]:
    """Ids that are the highest of their bucket, ascending, the highest of all last."""
    n, top = ids.agg(F.count(F.lit(1)), F.max("doc_id")).first()
    if top is None:
        return []
    buckets = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    every = -(-n // SAMPLE)
    sample = ids.where("doc_id IS NOT NULL").where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    shares = [k / buckets for k in range(1, buckets)]
    found = sample.agg(F.percentile_approx("doc_id", shares, 10 * MAX_BUCKETS)).first()[0] if shares else []
    return sorted({*(found or []), top})


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """The number of bounds below ``doc_id``, by groups of bounds and then inside one; null is in the lowest."""
    side = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[k : k + side] for k in range(0, len(bounds), side)]
    tops = F.lit([g[-1] for g in groups])
    group = F.size(F.filter(tops, lambda b: b < doc_id))
    inside = F.size(F.filter(F.element_at(F.array(*(F.lit(g) for g in groups)), group + 1), lambda b: b < doc_id))
    return F.when(doc_id.isNull(), 0).otherwise(group * side + inside)


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """``doc_id`` and ``text`` of every row and guest, dealt to buckets, and the window in which the next row follows."""
    bounds = _bounds(docs.select("doc_id"))
    rows = docs.select("doc_id", text_of().alias("text"))
    own = _bucket(F.col("doc_id"), bounds) if bounds else F.lit(0)
    above = F.when(own + 1 < len(bounds), own + 1).otherwise(0)
    guest_of = F.struct(above.alias("bucket"), F.lit(True).alias("guest"))
    home = F.struct(own.alias("bucket"), F.lit(False).alias("guest"))
    is_top = F.col("doc_id").isin(bounds) if bounds else F.lit(True)
    places = F.when(is_top, F.array(home, guest_of)).otherwise(F.array(home))
    rows = rows.select("*", F.explode(places).alias("_at")).select("doc_id", "text", "_at.*")
    rows = rows.withColumn("digest", F.xxhash64("text"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "digest")
    return rows, order


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to the edited and the next text's.

    The edited text has the last half of the text replaced by as much of the start of the next document.
    """
    rows, order = with_next(docs)
    rows = rows.withColumn("next_text", F.lead("text").over(order))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    head = F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), head))
    rows = with_anchors(with_anchors(rows, "text", "anchors"), "edited", "edited_anchors")
    rows = rows.select(
        "bucket",
        "guest",
        "digest",
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "anchors",
        "edited_anchors",
        hashes_of(F.col("anchors")).alias("hashes"),
        hashes_of(F.col("edited_anchors")).alias("edited_hashes"),
    )
    rows = rows.withColumn("next_hashes", F.lead("hashes").over(order)).where("NOT guest")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "anchors",
        "edited_anchors",
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
