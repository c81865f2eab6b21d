"""Categories of detected objects: weight, name, display label and box colour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Class id, name, health weight.
CATEGORIES = (
    (0, "background", 0.0),
    (1, "nozzle", 0.0),
    (2, "adhesion", -0.5),
    (3, "spaghetti", -0.5),
    (4, "print", 1.0),
    (5, "raft", 1.0),
)

# Colour names in palette order.
PALETTE = tuple(
    """
    AliceBlue Chartreuse Aqua Aquamarine Azure Beige Bisque BlanchedAlmond BlueViolet BurlyWood
    CadetBlue AntiqueWhite Chocolate Coral CornflowerBlue Cornsilk Crimson Cyan DarkCyan
    DarkGoldenRod DarkGrey DarkKhaki DarkOrange DarkOrchid DarkSalmon DarkSeaGreen DarkTurquoise
    DarkViolet DeepPink DeepSkyBlue DodgerBlue FireBrick FloralWhite ForestGreen Fuchsia Gainsboro
    GhostWhite Gold GoldenRod Salmon Tan HoneyDew HotPink IndianRed Ivory Khaki Lavender
    LavenderBlush LawnGreen LemonChiffon LightBlue LightCoral LightCyan LightGoldenRodYellow
    LightGray LightGrey LightGreen LightPink LightSalmon LightSeaGreen LightSkyBlue LightSlateGray
    LightSlateGrey LightSteelBlue LightYellow Lime LimeGreen Linen Magenta MediumAquaMarine
    MediumOrchid MediumPurple MediumSeaGreen MediumSlateBlue MediumSpringGreen MediumTurquoise
    MediumVioletRed MintCream MistyRose Moccasin NavajoWhite OldLace Olive OliveDrab Orange
    OrangeRed Orchid PaleGoldenRod PaleGreen PaleTurquoise PaleVioletRed PapayaWhip PeachPuff Peru
    Pink Plum PowderBlue Purple Red RosyBrown RoyalBlue SaddleBrown Green SandyBrown SeaGreen
    SeaShell Sienna Silver SkyBlue SlateBlue SlateGray SlateGrey Snow SpringGreen SteelBlue
    GreenYellow Teal Thistle Tomato Turquoise Violet Wheat White WhiteSmoke Yellow YellowGreen
    """.split()
)
# Colour for boxes without class, colour for boxes without score, step between
# the colours of successive track ids (a prime near a tenth of the palette, not dividing it).
AGNOSTIC_COLOR = "DarkOrange"
UNSCORED_COLOR = "black"
TRACK_STEP = 13


def category_table(spark: SparkSession) -> DataFrame:
    """The categories as a table ``(class, name, health_weight)``; always six rows."""
    rows = ", ".join(f"({key}, '{name}', {weight}D)" for key, name, weight in CATEGORIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(class, name, health_weight)")


def _lookup(label: Column, column: int) -> Column:
    """Value of a category by its id, which counts up from 0; null outside the table."""
    return F.get(F.array(*(F.lit(row[column]) for row in CATEGORIES)), label.cast("int"))


def health_weight(label: Column, strict: bool = False) -> Column:
    """Health weight of a class; an unknown class gives null, or an error when ``strict``."""
    weight = _lookup(label, 2)
    if not strict:
        return weight
    problem = F.concat(F.lit("unknown class "), F.coalesce(label.cast("string"), F.lit("null")))
    return F.coalesce(weight, F.raise_error(problem).cast("double"))


def category_name(label: Column) -> Column:
    return F.coalesce(_lookup(label, 1), F.lit("N/A"))


def display_label(
    label: Column,
    score: Column,
    track_id: Column | None = None,
    *,
    skip_labels: bool = False,
    skip_scores: bool = False,
    skip_track_ids: bool = False,
    agnostic: bool = False,
) -> Column:
    """Text next to a box: name, whole percent and track id, as far as each is wanted."""
    parts = []
    if not skip_labels and not agnostic:
        parts.append(category_name(label))
    if not skip_scores:
        # A score that is no finite number has no percentage.
        parts.append(F.concat((100 * score).try_cast("int").cast("string"), F.lit("%")))
    if track_id is not None and not skip_track_ids:
        parts.append(F.concat(F.lit("ID "), track_id.cast("string")))
    return F.concat_ws(": ", *parts) if parts else F.lit("")


def box_color(
    label: Column,
    score: Column | None = None,
    track_id: Column | None = None,
    *,
    agnostic: bool = False,
) -> Column:
    """Colour of a box. Pass ``score`` to give boxes with a null score the colour for unscored boxes."""
    palette = F.array(*(F.lit(name) for name in PALETTE))
    if agnostic:
        color = F.lit(AGNOSTIC_COLOR)
    elif track_id is not None:
        turn = F.pmod(track_id.cast("bigint"), F.lit(len(PALETTE))) * TRACK_STEP
        color = F.get(palette, F.pmod(turn, F.lit(len(PALETTE))).cast("int"))
    else:
        color = F.get(palette, F.pmod(label, F.lit(len(PALETTE))).cast("int"))
    if score is None:
        return color
    return F.when(score.isNull(), F.lit(UNSCORED_COLOR)).otherwise(color)
