"""Images as rows of pixels (image, x, y, value or rgb): photographs, films and their masks. Decoding is outside; rows come from whoever decodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from .records import clusters

BOX = "struct<x0: long, y0: long, x1: long, y1: long>"


def photos(pixels: DataFrame, colour: str = "rgb", share: float = P.PHOTO_SHARE) -> DataFrame:
    """image, colours, pixels, photo: photographs have many colours for their size. Counts are exact at any number of colours, as different ones are counted after a sum for each."""
    each = pixels.groupBy("image", colour).agg(F.count(F.lit(1)).alias("_n"))
    out = each.groupBy("image").agg(F.count(F.lit(1)).alias("colours"), F.sum("_n").alias("pixels"))
    return out.withColumn("photo", F.col("colours") / F.col("pixels") > share)


def percentiles(pixels: DataFrame, value: str = "value", **at: float) -> DataFrame:
    """Exact percentiles of each image, between neighbours by proportion, cut to whole numbers. Equal values are summed first, so a group holds a row for each grey level."""
    each = pixels.groupBy("image", value).agg(F.count(F.lit(1)).alias("_n"))
    return each.groupBy("image").agg(*(F.floor(F.percentile(value, p, F.col("_n"))).cast("long").alias(name) for name, p in at.items()))


def row_means(pixels: DataFrame, value: str = "value") -> DataFrame:
    return pixels.groupBy("image", "y").agg(F.avg(value).alias("mean"))


def separators(means: DataFrame, height: int, gap: int = P.SEPARATOR_GAP, margin: int = P.SEPARATOR_MARGIN) -> DataFrame:
    """image, centre of the bright lines between rows of tiles: rows brighter than the 99th percentile of the image's, in groups, away from both ends."""
    bound = means.groupBy("image").agg(F.percentile("mean", 0.99).alias("_bound"))
    bright = means.join(bound, "image").filter(F.col("mean") > F.col("_bound")).select("image", "y")
    found = clusters(bright, "image", "y", gap)
    return found.filter((F.col("centre") > margin) & (F.col("centre") < height - margin)).select("image", "centre")


def band_boxes(seps: DataFrame, images: DataFrame, band: int = 100, top: int = P.FILM_TOP) -> DataFrame:
    """image, boxes of films (image, width, height) whose tile rows begin after their separators: the banner, and a band at the top of each row."""
    own = seps.groupBy("image").agg(F.array_sort(F.collect_list(F.col("centre") + 1)).alias("_starts"))
    starts = F.concat(F.array(F.lit(top).cast("long")), F.coalesce("_starts", F.array().cast("array<long>")))
    box = lambda y0, y1: F.struct(F.lit(0).cast("long").alias("x0"), y0.cast("long").alias("y0"), F.col("width").cast("long").alias("x1"), y1.cast("long").alias("y1"))
    bands = F.transform(starts, lambda y: box(y, F.least(F.col("height").cast("long"), y + band)))
    return images.join(own, "image", "left").select("image", F.concat(F.array(box(F.lit(0), F.lit(top))), bands).alias("boxes"))


def tile_boxes(width: int, height: int) -> list[tuple[int, int, int, int]]:
    """x0, y0, x1, y1 of what a film of fixed tiles shows of a patient: the banner, and in each tile the name's and the vendor's corner."""
    high, wide = (height - P.FILM_TOP - P.FILM_FOOT) // P.FILM_ROWS, width // P.FILM_COLUMNS
    boxes = [(0, 0, width, P.FILM_TOP)]
    for row in range(P.FILM_ROWS):
        for column in range(P.FILM_COLUMNS):
            x, y = column * wide, P.FILM_TOP + row * high
            boxes += [(x, y, x + P.TILE_NAME[1], y + P.TILE_NAME[0]), (x + wide - P.TILE_VENDOR[1], y, x + wide, y + P.TILE_VENDOR[0])]
    return boxes


def capture_boxes(images: DataFrame) -> DataFrame:
    """image, boxes of secondary captures (image, description, width, height): films of tiles and dose reports; no boxes for others, which must be looked at."""
    x = F.col("width").cast("long")
    shape = lambda x0, y0, x1, y1: F.struct(x0.cast("long").alias("x0"), y0.cast("long").alias("y0"), x1.cast("long").alias("x1"), y1.cast("long").alias("y1"))
    high, wide = F.floor((F.col("height") - P.FILM_TOP - P.FILM_FOOT) / P.FILM_ROWS), F.floor(F.col("width") / P.FILM_COLUMNS)
    places = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(P.FILM_ROWS - 1)), lambda r: F.transform(F.sequence(F.lit(0), F.lit(P.FILM_COLUMNS - 1)), lambda c: F.struct((c * wide).alias("x"), (P.FILM_TOP + r * high).alias("y")))))
    corners = F.flatten(F.transform(places, lambda p: F.array(shape(p["x"], p["y"], p["x"] + P.TILE_NAME[1], p["y"] + P.TILE_NAME[0]), shape(p["x"] + wide - P.TILE_VENDOR[1], p["y"], p["x"] + wide, p["y"] + P.TILE_VENDOR[0]))))
    film = F.concat(F.array(shape(F.lit(0), F.lit(0), x, F.lit(P.FILM_TOP))), corners)
    dose = F.array(shape(F.lit(P.DOSE_LEFT), F.lit(P.DOSE_ROWS[0]), x, F.lit(P.DOSE_ROWS[1])))
    is_film = F.col("description").contains("Electronic film") & (F.col("width") > P.FILM_WIDTH)
    boxes = F.when(is_film, film).when(F.col("description").contains("Dose"), dose).otherwise(F.array().cast(f"array<{BOX}>"))
    return images.select("image", boxes.alias("boxes"))


#: Parts of an image that are joined to what belongs to the image apart from each other.
IMAGE_PARTS = 64


def with_image(pixels: DataFrame, own: DataFrame, how: str = "inner") -> DataFrame:
    """Pixels with the columns of their image's row (image, ...). A large image's pixels don't meet in one task: they are dealt by their place, and the image's row is repeated for each part."""
    part = F.pmod(F.xxhash64("x", "y"), F.lit(IMAGE_PARTS)).cast("int")
    repeated = own.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(IMAGE_PARTS - 1))))
    return pixels.withColumn("_part", part).join(repeated, ["image", "_part"], how).drop("_part")


def masked(pixels: DataFrame, boxes: DataFrame, fills: DataFrame, value: str = "value") -> DataFrame:
    """Pixels with those in a box of their image set to the image's fill (image, fill). Boxes are a list on each image's row, so pixels aren't multiplied."""
    per_image = boxes.join(fills.select("image", "fill"), "image")
    joined = with_image(pixels, per_image, "left")
    return joined.withColumn(value, F.when(inside(F.col("boxes")), F.col("fill")).otherwise(F.col(value))).drop("boxes", "fill")


def inside(boxes: Column) -> Column:
    return F.coalesce(F.exists(boxes, lambda b: (F.col("x") >= b["x0"]) & (F.col("x") < b["x1"]) & (F.col("y") >= b["y0"]) & (F.col("y") < b["y1"])), F.lit(False))


def coarse(pixels: DataFrame, sizes: DataFrame, edge: int = 16, value: str = "value") -> DataFrame:
    """Photographs with the long edge cut down to `edge` blocks, each pixel the mean of its block: what was to be read is gone, not hidden. sizes: image, width, height.

    Blocks aren't smoothed into each other, which takes nothing away further."""
    step = F.ceil(F.greatest("width", "height") / edge)
    placed = with_image(pixels, sizes.select("image", step.alias("_step"))).withColumn("_bx", F.floor(F.col("x") / F.col("_step"))).withColumn("_by", F.floor(F.col("y") / F.col("_step")))
    means = placed.groupBy("image", "_bx", "_by").agg(F.avg(value).alias("_mean"))
    return placed.join(means, ["image", "_bx", "_by"]).withColumn(value, F.col("_mean")).drop("_step", "_bx", "_by", "_mean")


def painted(pixels: DataFrame, words: DataFrame, value: str = "value", blank: float = 255.0) -> DataFrame:
    """Pixels with the boxes of words (image, x, y, w, h) and a margin around them filled by the background beside each word, which is taken from the pixels as they come; `blank` where
    there is none. Of several boxes over a pixel the last in reading order counts. Who reads the words again can paint again, until nothing is read."""
    pad = P.BOX_MARGIN
    box = F.struct((F.col("y") - pad).alias("y0"), (F.col("x") - pad).alias("x0"), (F.col("y") + F.col("h") + pad).alias("y1"), (F.col("x") + F.col("w") + pad).alias("x1"))
    at = words.select("image", box.alias("_box"), F.greatest(F.col("x") - pad, F.lit(0)).alias("x"), F.greatest(F.col("y") + F.floor(F.col("h") / 2), F.lit(0)).alias("y"))
    filled = at.join(pixels.select("image", "x", "y", F.col(value).alias("_fill")), ["image", "x", "y"], "left").withColumn("_fill", F.coalesce("_fill", F.lit(blank)))
    boxes = filled.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("_box.y0", "_box.x0", "_box.y1", "_box.x1", "_fill"))).alias("_boxes"))
    over = F.filter("_boxes", lambda b: F.col("x").between(b["x0"], b["x1"]) & F.col("y").between(b["y0"], b["y1"]))
    return with_image(pixels, boxes, "left").withColumn(value, F.coalesce(F.try_element_at(over, F.lit(-1))["_fill"], F.col(value))).drop("_boxes")
