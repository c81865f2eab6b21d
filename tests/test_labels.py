import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from framekeel.functions import PALETTE, box_color, category_name, category_table, display_label, health_weight


def row(spark, *columns):
    return tuple(spark.sql("SELECT 4 c, 9 unknown, 0.579D s, 12 t, 131 wide, cast(null AS double) none").select(*columns).first())


def test_weights_and_names(spark):
    found = {r["class"]: (r["name"], r["health_weight"]) for r in category_table(spark).collect()}
    assert found[3] == ("spaghetti", -0.5) and found[5] == ("raft", 1.0) and len(found) == 6
    got = row(spark, health_weight(F.col("c")), health_weight(F.col("unknown")), category_name(F.col("c")), category_name(F.col("unknown")))
    assert got == (1.0, None, "print", "N/A")


def test_strict_weight_raises(spark):
    assert row(spark, health_weight(F.col("c"), strict=True)) == (1.0,)
    with pytest.raises(PySparkException):
        row(spark, health_weight(F.col("unknown"), strict=True))


def test_label_variants(spark):
    c, s, t = F.col("c"), F.col("s"), F.col("t")
    got = row(
        spark,
        display_label(c, s),
        display_label(c, s, t),
        display_label(c, s, t, skip_track_ids=True),
        display_label(c, s, skip_labels=True),
        display_label(c, s, skip_scores=True),
        display_label(c, s, agnostic=True),
        display_label(F.col("unknown"), s),
        display_label(c, s, t, skip_labels=True, skip_scores=True),
        display_label(c, s, skip_labels=True, skip_scores=True),
    )
    assert got == ("print: 57%", "print: 57%: ID 12", "print: 57%", "57%", "print", "57%", "N/A: 57%", "ID 12", "")


def test_colors(spark):
    assert len(PALETTE) == 126 and len(set(PALETTE)) == 126
    got = row(
        spark,
        box_color(F.col("c")),
        box_color(F.col("wide")),
        box_color(F.col("c"), track_id=F.col("t")),
        box_color(F.col("c"), F.col("none")),
        box_color(F.col("c"), F.col("s"), agnostic=True),
    )
    assert got == ("Azure", PALETTE[5], PALETTE[(13 * 12) % 126], "black", "DarkOrange")
