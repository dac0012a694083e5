"""Labels on drawings: words of a page and the labels that neighbouring words make together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Limits in heights of the second part: rows up and sideways of a part above, sideways gap and drift of a part before.
ABOVE, ASIDE, GAP, DRIFT = (-1.7, -0.6), 1.2, (-0.3, 1.6), 0.35
#: The furthest a first part may lie, in heights: parts meet in cells of this size times the height's power of two.
REACH = 2.0


def reading_frame(words: DataFrame) -> DataFrame:
    """along, across, height and width of each word's box as it is read; dir: quarter turns (0 left to right, 1 down, 2 upside down, 3 up)."""
    cx, cy, d = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, F.col("dir")
    side = d.isin(1, 3)
    turned = lambda zero, one, two, three: F.when(d == 1, one).when(d == 2, two).when(d == 3, three).otherwise(zero)
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return words.withColumn("along", turned(cx, cy, -cx, -cy)).withColumn("across", turned(cy, -cx, -cy, cx)).withColumn("height", F.when(side, w).otherwise(h)).withColumn("width", F.greatest(w, h))


def merged_labels(words: DataFrame, first: Column, second: Column) -> DataFrame:
    """page, id, first_id, label, form, x0, y0, x1, y1 of every second part (a word that `second` accepts) joined to the best first part that `first` accepts.

    words: page, id, dir, x0, y0, x1, y1, text. A first part stands on the row above and centred (stacked) or before it on the same row (inline), in reading
    direction; stacked goes before inline, nearer before further, then the smaller id. Parts meet by grid cell, so a page with many words is not paired
    with itself. Words without height or text make no label.
    """
    w = reading_frame(words).where("height > 0 AND text <> ''")
    # cells grow with the height of the second part; a first part enters the cells of every height in use on its page
    step = lambda h: F.pow(F.lit(2.0), F.ceil(F.log2(h)))
    e = w.where(second).withColumn("cell", step(F.col("height")))
    sizes = e.select("page", "dir", "cell").distinct()
    s = w.where(first).select("page", "dir", *(F.col(c).alias(f"s_{c}") for c in ("id", "text", "along", "across", "width", "x0", "y0", "x1", "y1"))).join(sizes, ["page", "dir"])
    at = lambda c, size: F.floor(F.col(c) / (size * REACH)).cast("long")
    s = s.withColumn("_y", at("s_across", F.col("cell"))).withColumn("_x", at("s_along", F.col("cell")))
    # a row above lies within two heights; before it on the row a first part reaches as far as both widths, so rows meet whole
    e = e.withColumn("_row", at("across", F.col("cell"))).withColumn("_y", F.explode(F.array(F.col("_row") - 1, F.col("_row"), F.col("_row") + 1)))
    cells = F.ceil((F.col("width") + F.col("_wide")) / 2 / (F.col("cell") * REACH)).cast("long") + 1
    widest = s.groupBy("page", "dir", "cell").agg(F.max("s_width").alias("_wide"))
    e = e.join(widest, ["page", "dir", "cell"]).withColumn("_col", at("along", F.col("cell"))).withColumn("_x", F.explode(F.sequence(F.col("_col") - cells, F.col("_col") + 1)))
    near = e.join(s, ["page", "dir", "cell", "_y", "_x"]).where("id <> s_id")
    h = F.col("height")
    da, dc = (F.col("s_along") - F.col("along")) / h, (F.col("s_across") - F.col("across")) / h
    gap = (-da * h - F.col("s_width") / 2 - F.col("width") / 2) / h
    stacked = dc.between(*ABOVE) & (F.abs(da) <= ASIDE)
    inline = (F.abs(dc) <= DRIFT) & (da < 0) & gap.between(*GAP)
    near = near.withColumn("form", F.when(stacked, "stacked").when(inline, "inline")).where("form IS NOT NULL").withColumn("_score", F.when(stacked, F.abs(da) + F.abs(dc + 1.1)).otherwise(gap + 2))
    best = near.groupBy("page", "id").agg(F.min_by(F.struct("s_id", "s_text", "text", "form", F.least("x0", "s_x0").alias("x0"), F.least("y0", "s_y0").alias("y0"), F.greatest("x1", "s_x1").alias("x1"), F.greatest("y1", "s_y1").alias("y1")), F.struct("_score", "s_id")).alias("b"))
    return best.select("page", "id", F.col("b.s_id").alias("first_id"), F.concat("b.s_text", "b.text").alias("label"), "b.form", "b.x0", "b.y0", "b.x1", "b.y1")


def table_rows(words: DataFrame, least: int = 5, spacing: float = 2.6, edge: float = 2.0) -> DataFrame:
    """page, id of words that stand in a column of a table: `least` or more with one starting edge, each within `spacing` heights of the one before."""
    d = F.col("dir")
    start = F.when(d == 1, F.col("y0")).when(d == 2, -F.col("x1")).when(d == 3, -F.col("y1")).otherwise(F.col("x0"))
    w = reading_frame(words).withColumn("_edge", F.bround(start / edge))
    by = W.partitionBy("page", "dir", "_edge").orderBy("across", "height", "id")
    before = F.struct(F.lag("across").over(by).alias("c"), F.lag("height").over(by).alias("h"))
    w = w.withColumn("_b", before).withColumn("_new", (F.col("_b.c").isNull() | (F.col("across") - F.col("_b.c") > spacing * F.greatest(F.col("_b.h"), F.lit(1.0)))).cast("int"))
    w = w.withColumn("_run", F.sum("_new").over(by)).withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("page", "dir", "_edge", "_run")))
    return w.where(F.col("_n") >= least).select("page", "id")


#: How a channel's legs follow its sensor.
LEGS = {"in": 0, "relay": 1, "rec": 2}


def channel_legs(legs: DataFrame, place: list[str], source: list[str]) -> DataFrame:
    """legs (id, kind, `place`, `source`) -> id, kind, `place` of the channel, position from 0, siblings: what hangs on one monitor channel, its sensor (kind 'in') first.
    A sensor's channel is its own place, any other leg's is its source, by the first column of place (the panel) and `source`; legs without one go. Channels
    without a sensor or with several are left out. siblings counts the sensors on the same module (place without its last column), itself not included.

    Sensors are counted in an aggregate ahead of the window, so a channel that many legs share without one sensor never comes to one task.
    """
    own = [F.when(F.col("kind") == "in", F.col(p)).otherwise(F.col(s)).alias(p) for p, s in zip(place[1:], source, strict=True)]
    at = legs.select("id", "kind", place[0], *own).dropna(subset=place)
    single = at.where("kind = 'in'").groupBy(*place).count().where("count = 1").drop("count")
    sensors = at.where("kind = 'in'").groupBy(*place[:-1]).agg(F.count(F.lit(1)).alias("_n"))
    order = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in LEGS.items() for x in kv)), F.col("kind")), F.lit(len(LEGS)))
    chain = at.join(single, place).withColumn("position", F.row_number().over(W.partitionBy(*place).orderBy(order, "id")) - 1)
    return chain.join(sensors, place[:-1]).select("id", "kind", *place, "position", (F.col("_n") - 1).alias("siblings"))
