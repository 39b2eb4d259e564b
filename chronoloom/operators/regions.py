"""Error regions on a mosaic of detectors: cuts that a polygon touches, and neighbouring detectors that it reaches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Cameras from the top of the mosaic for a northern pointing (a southern one has them from the bottom), and each camera place's detectors, two rows of two.
CAMERAS_NORTH = (4, 3, 2, 1)
DETECTORS = (((4, 3), (1, 2)), ((4, 3), (1, 2)), ((2, 1), (3, 4)), ((2, 1), (3, 4)))

#: The eight sides and corners of a detector in its own frame: x to the right, y up.
SIDES = tuple((sx, sy) for sx in (-1, 0, 1) for sy in (-1, 0, 1) if sx or sy)


def impacted_boxes(vertices: DataFrame, boxes: DataFrame, region: str, order: str, width: float, keys: Sequence[str] = ()) -> DataFrame:
    """Boxes that a polygon touches: ``(*keys, region, box, how)``, each pair once.

    ``vertices (*keys, region, order, x, y)`` go round each region; ``boxes (*keys,
    box, x0, y0, x1, y1, cx, cy)`` are at most ``width`` wide and high. A box is
    ``passed`` if a vertex lies strictly inside it, else ``inside`` if the polygon
    holds its centre (an odd number of edges to the right of it). Missing vertices
    drop out, regions of fewer than three hold no centre.

    Vertices and boxes meet in cells of ``width``. Edges meet centres in the rows of
    cells that an edge passes, behind the region's bounds.
    """
    keys = list(keys)
    cell = lambda c: F.floor(c / width).cast("long")
    v = vertices.select(*keys, region, order, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).filter("x is not null and y is not null")
    corners = F.array(*[F.struct((cell(F.col("x0")) + i).alias("i"), (cell(F.col("y0")) + j).alias("j")) for i in (0, 1) for j in (0, 1)])
    listed = boxes.withColumn("_c", F.explode(corners)).select(*keys, "box", "x0", "y0", "x1", "y1", F.col("_c.i").alias("_i"), F.col("_c.j").alias("_j"))
    hit = v.withColumns({"_i": cell(F.col("x")), "_j": cell(F.col("y"))}).join(listed, [*keys, "_i", "_j"]).filter("x > x0 and x < x1 and y > y0 and y < y1")
    passed = hit.select(*keys, region, "box").distinct()
    w = Window.partitionBy(*keys, region).orderBy(order)
    whole = Window.partitionBy(*keys, region)
    following = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(w))
    edges = v.withColumns({"xn": following("x"), "yn": following("y"), "_left": F.min("x").over(whole), "_right": F.max("x").over(whole)}).filter("y <> yn")
    rows = F.sequence(cell(F.least("y", "yn")), cell(F.greatest("y", "yn")))
    columns = F.sequence(cell(F.col("_left")), cell(F.col("_right")))
    edges = edges.withColumn("_j", F.explode(rows)).withColumn("_i", F.explode(columns))
    centres = boxes.select(*keys, "box", "cx", "cy").withColumns({"_i": cell(F.col("cx")), "_j": cell(F.col("cy"))})
    crossed = ((F.col("y") > F.col("cy")) != (F.col("yn") > F.col("cy"))) & (F.col("cx") < (F.col("xn") - F.col("x")) * (F.col("cy") - F.col("y")) / (F.col("yn") - F.col("y")) + F.col("x"))
    inside = edges.join(centres, [*keys, "_i", "_j"]).filter(crossed).groupBy(*keys, region, "box").agg(F.count("*").alias("_n")).filter("_n % 2 = 1").drop("_n")
    both = passed.withColumn("_p", F.lit(1)).unionByName(inside.withColumn("_p", F.lit(0)))
    return both.groupBy(*keys, region, "box").agg(F.when(F.max("_p") == 1, "passed").otherwise("inside").alias("how"))


def adjacency(spark: SparkSession) -> DataFrame:
    """Neighbours on the mosaic: ``(north, camera, ccd, sx, sy, next_camera, next_ccd)``, at most eight a detector.

    The mosaic has two columns of detectors, two rows a camera. The upper row of
    each camera is turned by half, so its own right is the mosaic's left.
    """
    rows = []
    for north in (True, False):
        cameras = CAMERAS_NORTH if north else CAMERAS_NORTH[::-1]
        place = {(2 * c + i, j): (cameras[c], DETECTORS[c][i][j]) for c in range(4) for i in (0, 1) for j in (0, 1)}
        for (row, col), here in place.items():
            turn = -1 if row % 2 == 0 else 1
            rows += [(north, *here, sx, sy, *place[row - turn * sy, col + turn * sx]) for sx, sy in SIDES if (row - turn * sy, col + turn * sx) in place]
    return spark.createDataFrame(rows, "north boolean, camera int, ccd int, sx int, sy int, next_camera int, next_ccd int")


def reached_detectors(vertices: DataFrame, keys: Sequence[str], north: str, camera: str, ccd: str, width: float = 2136, height: float = 2078, least: float = 10_000) -> DataFrame:
    """Neighbouring detectors that a region's polygon reaches from its own: ``(*keys, next_camera, next_ccd, sx, sy, size, enough)``.

    A side counts as reached if a vertex lies strictly beyond it, a corner if both of
    its sides do. ``size`` is the area of the box around the vertices on or beyond the side, within
    the detector's height (or width), or on and beyond the corner; 0 without any. Whether that pays
    is ``enough``: over ``least`` pixels. Mosaic edges have no neighbour. One
    aggregate a region; the neighbours are a table of fixed size.
    """
    keys = list(keys)
    x, y = F.col("x"), F.col("y")

    def beyond(sx: int, sy: int) -> Column:
        across = {-1: x <= 0, 0: (x >= 0) & (x <= width), 1: x >= width}[sx]
        along = {-1: y <= 0, 0: (y >= 0) & (y <= height), 1: y >= height}[sy]
        return across & along

    edge = {(-1, 0): F.min(x) < 0, (1, 0): F.max(x) > width, (0, -1): F.min(y) < 0, (0, 1): F.max(y) > height}
    own = list(dict.fromkeys([*keys, north, camera, ccd]))
    sides = []
    for sx, sy in SIDES:
        c = beyond(sx, sy)
        span = lambda a, c=c: F.max(F.when(c, a)) - F.min(F.when(c, a))
        hit = edge[sx, sy] if not (sx and sy) else edge[sx, 0] & edge[0, sy]
        sides.append(F.struct(F.lit(sx).alias("sx"), F.lit(sy).alias("sy"), F.coalesce(span(x) * span(y), F.lit(0.0)).alias("size"), hit.alias("hit")))
    reached = vertices.groupBy(*own).agg(F.array(*sides).alias("_s")).select(*own, F.explode("_s").alias("_s")).filter("_s.hit").select(*own, "_s.sx", "_s.sy", "_s.size")
    near = adjacency(vertices.sparkSession).select(F.col("north").alias("_n"), F.col("camera").alias("_c"), F.col("ccd").alias("_d"), "sx", "sy", "next_camera", "next_ccd")
    met = reached.join(F.broadcast(near.withColumnsRenamed({"sx": "_sx", "sy": "_sy"})), (F.col(north) == F.col("_n")) & (F.col(camera) == F.col("_c")) & (F.col(ccd) == F.col("_d")) & (F.col("sx") == F.col("_sx")) & (F.col("sy") == F.col("_sy")))
    return met.select(*keys, "next_camera", "next_ccd", "sx", "sy", "size", (F.col("size") > least).alias("enough"))
