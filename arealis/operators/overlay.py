"""Union outline of overlapping or badly matched areas: noding on a grid, then winding numbers.

Coordinates are whole numbers on a grid of 2**29 steps over the layer, four units to a step, so that every
side-of-a-line test is exact in 64 bits.  Edges that run both ways cancel first; for matched boundaries
little is left then.  What is left is split at vertices and crossings, found by a join over square cells, until
nothing splits.  How often each side of an edge is covered follows from a path to the corner of its cell,
which meets edges of that cell alone, and from the corner's own number, a running sum along its row of cells.
An edge is on the outline if exactly one side is covered.

Cells are as wide as the mean edge of their area, so an edge lies in few cells and work grows with the edges.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.session import written

#: Steps of the grid over the longer side of a layer, and units a step.
STEPS = 1 << 29
UNIT = 4
#: Rounds of splitting; crossings move edges by at most half a step, so few are ever needed.
MAX_ROUNDS = 32

EDGE = ["ax", "ay", "bx", "by"]


@dataclass(frozen=True)
class Grid:
    """Where a layer's grid begins and how wide a step is, a power of two."""

    x: float
    y: float
    step: float

    def unit(self, value: Column, origin: float) -> Column:
        return (F.rint((value - F.lit(origin)) / F.lit(self.step)) * UNIT).cast("long")

    def place(self, value: Column, origin: float) -> Column:
        return F.lit(origin) + value * F.lit(self.step / UNIT)


def grid_over(edges: DataFrame) -> Grid | None:
    """The grid of all edges; None without edges."""
    low_x, low_y, high_x, high_y = edges.agg(
        F.min(F.least("ax", "bx")), F.min(F.least("ay", "by")),
        F.max(F.greatest("ax", "bx")), F.max(F.greatest("ay", "by")),
    ).first()
    if low_x is None:
        return None
    size = max(abs(v) for v in (low_x, low_y, high_x, high_y))
    extent = max(high_x - low_x, high_y - low_y, 1e-9 * max(1.0, size))
    step = 2.0 ** math.ceil(math.log2(extent / (STEPS - 2)))
    return Grid(math.floor(low_x / step) * step, math.floor(low_y / step) * step, step)


def orient(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Above zero if p lies to the left of the line from a to b."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _side(ax: str, ay: str, bx: str, by: str, px: str, py: str) -> str:
    """:func:`orient` in SQL."""
    return f"(({bx} - {ax}) * ({py} - {ay}) - ({by} - {ay}) * ({px} - {ax}))"


def _c(prefix: str, *names: str) -> list[Column]:
    return [F.col(prefix + n) for n in names]


def net_edges(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, its lower end first, with how often it runs upwards more than downwards."""
    return edges.groupBy("g", *EDGE).agg(F.sum("n").alias("n")).filter("n <> 0")


def _lower_first(g: Column, a: tuple[Column, Column], b: tuple[Column, Column], n: Column) -> list[Column]:
    ahead = (a[0] < b[0]) | ((a[0] == b[0]) & (a[1] < b[1]))
    ends = [F.when(ahead, p).otherwise(q) for p, q in ((a[0], b[0]), (a[1], b[1]), (b[0], a[0]), (b[1], a[1]))]
    return [g.alias("g"), *(e.alias(c) for e, c in zip(ends, EDGE, strict=True)),
            F.when(ahead, n).otherwise(-n).alias("n")]


def _cell(value: Column, width: Column) -> Column:
    """Cell of a coordinate; walls lie at one unit beyond a multiple of the width, where no vertex is."""
    return F.floor((value - 1) / width)


def cell_widths(edges: DataFrame) -> DataFrame:
    """(g, w): width of the cells of each area."""
    reach = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    return edges.groupBy("g").agg(
        F.greatest(F.lit(UNIT), F.ceil(F.avg(reach) / UNIT) * UNIT).cast("long").alias("w")
    )


def in_cells(edges: DataFrame) -> DataFrame:
    """Edges with a cell width ``w`` once for every cell (i, j) that they touch."""
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = edges.withColumn(
        "j", F.explode(F.sequence(_cell(low, F.col("w")), _cell(high, F.col("w"))))
    )
    wall = F.col("j") * F.col("w") + 1
    slope = (F.col("bx") - F.col("ax")).cast("double") / F.when(
        F.col("by") != F.col("ay"), (F.col("by") - F.col("ay")).cast("double")
    )

    def x_at(y: Column) -> Column:
        return F.col("ax") + (y - F.col("ay")) * slope

    below, above = F.greatest(wall, low), F.least(wall + F.col("w"), high)
    flat = F.col("ay") == F.col("by")
    # one unit more on both sides makes up for rounding; edges along an axis have none, the tests that follow are exact
    slack = F.when(flat | (F.col("ax") == F.col("bx")), 0).otherwise(1)
    left = F.when(flat, F.least("ax", "bx")).otherwise(F.least(x_at(below), x_at(above))) - slack
    right = F.when(flat, F.greatest("ax", "bx")).otherwise(F.greatest(x_at(below), x_at(above))) + slack
    return rows.withColumn("i", F.explode(F.sequence(_cell(left, F.col("w")), _cell(right, F.col("w")))))


#: Names of the other edge's ends.
_OTHER = ["cx", "cy", "dx", "dy"]
#: Pairs (the lesser edge first) of which one may split the other: their boxes meet, and they do not only share an
#: end.  Ends are in order, so the end of one that is the other's beginning is all they share, and so is any
#: common end of edges with different directions.
_MAY_SPLIT = """(ax < cx or (ax = cx and (ay < cy or (ay = cy and (bx < dx or (bx = dx and by < dy))))))
    and cx <= bx and least(ay, by) <= greatest(cy, dy) and least(cy, dy) <= greatest(ay, by)
    and not (bx = cx and by = cy)
    and not (((ax = cx and ay = cy) or (bx = dx and by = dy)) and (bx - ax) * (dy - cy) <> (by - ay) * (dx - cx))"""


def _split_points(edges: DataFrame) -> DataFrame:
    """(g, edge, px, py): points inside an edge at which another one ends or crosses it."""
    cells = in_cells(edges.join(cell_widths(edges), "g")).select("g", "i", "j", *EDGE)
    other = cells.withColumnsRenamed(dict(zip(EDGE, _OTHER, strict=True)))
    # once for each pair, not for every cell that both touch
    pairs = (
        cells.join(other, ["g", "i", "j"])
        .filter(_MAY_SPLIT)
        .select("g", F.struct(*EDGE).alias("s"), F.struct(*(F.col(o).alias(c) for c, o in zip(EDGE, _OTHER, strict=True))).alias("t"))
        .distinct()
    )
    sides = pairs.selectExpr(
        "*",
        *(f"{_side(f'{e}.ax', f'{e}.ay', f'{e}.bx', f'{e}.by', f'{f}.{p}x', f'{f}.{p}y')} as {f}{p}"
          for e, f in (("s", "t"), ("t", "s")) for p in "ab"),
    ).withColumn("crossing", F.expr("signum(ta) * signum(tb) < 0 and signum(sa) * signum(sb) < 0"))
    met = sides.filter("crossing or ta = 0 or tb = 0 or sa = 0 or sb = 0").selectExpr(
        "*", "if(crossing, sa / nullif(cast(sa as double) - sb, 0), null) as share"
    )
    placed = met.selectExpr(
        "*",
        *(f"cast(rint((s.a{c} + share * (s.b{c} - s.a{c})) / {UNIT}) * {UNIT} as bigint) as c{c}" for c in "xy"),
    )

    def inside(e: str, x: str, y: str) -> str:
        """A point of the line within the edge's box, but neither of its ends."""
        return (
            f"{x} between least({e}.ax, {e}.bx) and greatest({e}.ax, {e}.bx)"
            f" and {y} between least({e}.ay, {e}.by) and greatest({e}.ay, {e}.by)"
            f" and not ({x} = {e}.ax and {y} = {e}.ay) and not ({x} = {e}.bx and {y} = {e}.by)"
        )

    cases = [(e, f"{f}{p} = 0", f"{f}.{p}x", f"{f}.{p}y") for e, f in (("s", "t"), ("t", "s")) for p in "ab"]
    cases += [(e, "crossing", "cx", "cy") for e in "st"]
    found = ", ".join(
        f"if({when} and {inside(e, x, y)}, struct({e} as e, {x} as px, {y} as py), null)" for e, when, x, y in cases
    )
    return placed.selectExpr("g", f"inline(array_compact(array({found})))").distinct()


def noded(edges: DataFrame) -> DataFrame:
    """Net edges that meet in nothing but common ends; the input is best a written table."""
    for _ in range(MAX_ROUNDS):
        points = _split_points(edges).transform(written, "overlay")
        if points.isEmpty():
            return edges
        named = edges.select("g", F.struct(*EDGE).alias("e"), "n")
        stops = named.join(points.select("g", "e").distinct(), ["g", "e"], "left_semi")
        whole = named.join(points.select("g", "e").distinct(), ["g", "e"], "left_anti")
        ends = F.array(*(F.struct(F.col(f"e.{x}").alias("px"), F.col(f"e.{y}").alias("py"))
                         for x, y in (("ax", "ay"), ("bx", "by"))))
        on_edge = (
            stops.select("g", "e", F.inline(ends))
            .unionByName(points.select("g", "e", "px", "py"))
            .join(stops, ["g", "e"])
        )
        # rounding keeps the order of each coordinate, so this is the order along the edge
        along = Window.partitionBy("g", "e").orderBy(
            "px", F.col("py") * F.when(F.col("e.by") < F.col("e.ay"), -1).otherwise(1)
        )
        pieces = (
            on_edge.withColumn("nx", F.lead("px").over(along))
            .withColumn("ny", F.lead("py").over(along))
            .filter("nx is not null and (nx <> px or ny <> py)")
        )
        g, n = F.col("g"), F.col("n")
        split = pieces.select(
            *_lower_first(g, (F.col("px"), F.col("py")), (F.col("nx"), F.col("ny")), n)
        )
        edges = net_edges(whole.select("g", "e.*", "n").unionByName(split)).transform(written, "overlay")
    raise RuntimeError(f"edges still cross after {MAX_ROUNDS} rounds of splitting")


class CellPaths:
    """Paths from points to the corners of their cells, and along the rows of corners.

    A query is a point (px, py) and a tip (tx, ty): the top of its own edge, or the point itself.  The
    path ends a little above the point and just left of its own edge.  It begins at the lower left corner of the
    point's cell, goes up the wall to the height of the point and right to it.
    """

    def __init__(self, edges: DataFrame) -> None:
        self.cells = in_cells(edges)

    @staticmethod
    def placed(queries: DataFrame) -> DataFrame:
        """Queries with the cell (i, j) of their point."""
        return queries.withColumn("i", _cell(F.col("px"), F.col("w"))).withColumn("j", _cell(F.col("py"), F.col("w")))

    def on_bottom_walls(self) -> DataFrame:
        """Edges that cross the bottom wall of their cell, with x of the crossing; each crossing once."""
        y, left = F.col("j") * F.col("w") + 1, F.col("i") * F.col("w") + 1
        up = F.col("by") > F.col("ay")
        low = [F.when(up, a).otherwise(b) for a, b in zip(_c("", "ax", "ay"), _c("", "bx", "by"), strict=True)]
        high = [F.when(up, b).otherwise(a) for a, b in zip(_c("", "ax", "ay"), _c("", "bx", "by"), strict=True)]
        crosses = (F.col("ay") < y) != (F.col("by") < y)
        return self.cells.filter(
            crosses & (orient(*low, *high, left, y) >= 0) & (orient(*low, *high, left + F.col("w"), y) < 0)
        ).withColumn(
            "at",
            F.col("ax")
            + (y - F.col("ay")).cast("double")
            * (F.col("bx") - F.col("ax"))
            / F.when(F.col("by") != F.col("ay"), F.col("by") - F.col("ay")),
        ).withColumn("up", up)

    def from_corner(self, queries: DataFrame) -> DataFrame:
        """Queries with the edges on their path: ``leg`` 0 up the wall, 1 to the right, ``at`` the place.

        Queries without an edge on their path are left out.  Columns of a query: g, q, w, px, py, tx, ty.
        """
        met = self.placed(queries).drop("w").join(self.cells, ["g", "i", "j"]).filter(
            "(ax < i * w + 1) != (bx < i * w + 1) or (ay <= py) != (by <= py)"  # what either leg asks for first
        )
        # a is the left end of an edge (or the lower one of an upright edge): ends are in order
        named = met.selectExpr(
            "*", "i * w + 1 as x", "j * w + 1 as y", "by > ay as up", "by < ay as falling",
            "if(by < ay, bx, ax) as lx", "if(by < ay, by, ay) as ly",
            "if(by < ay, ax, bx) as hx", "if(by < ay, ay, by) as hy",
            "cast(bx - ax as double) / nullif(by - ay, 0) as slope",
        ).selectExpr(
            "*",
            f"{_side('ax', 'ay', 'bx', 'by', 'x', 'y')} as corner",
            f"{_side('ax', 'ay', 'bx', 'by', 'x', 'py')} as turn",
            f"{_side('lx', 'ly', 'hx', 'hy', 'x', 'py')} as turn_left",
            f"{_side('lx', 'ly', 'hx', 'hy', 'px', 'py')} as point",
        )
        legs = named.withColumn(
            "legs",
            F.expr(f"""array_compact(array(
                if((ax < x) != (bx < x) and (corner < 0 or (corner = 0 and falling)) and turn >= 0, 0, null),
                if((ay <= py) != (by <= py)
                   and (turn_left > 0 or (turn_left = 0 and up and bx > ax))
                   and (point < 0 or (point = 0 and {_side('px', 'py', 'tx', 'ty', 'hx', 'hy')} > 0)), 1, null)))"""),
        )
        # an edge that lies across both legs is met twice
        return legs.withColumn("leg", F.explode("legs")).selectExpr(
            "* except (legs)",
            "if(leg = 1, ax + (py - ay) * slope, ay + cast(x - ax as double) * (by - ay) / nullif(bx - ax, 0)) as at",
            "if(leg = 1, slope, 0.0D) as lean",
        )


def left_of_corner() -> tuple[Window, Window]:
    """Cells of a row before a cell, in order."""
    row = Window.partitionBy("g", "j").orderBy("i")
    return row, row.rowsBetween(Window.unboundedPreceding, -1)


def covered(edges: DataFrame) -> DataFrame:
    """Outline of noded net edges: directed edges (g, EDGE) with the covered side on their left."""
    edges = edges.join(cell_widths(edges), "g")
    paths = CellPaths(edges)
    flat = F.col("ay") == F.col("by")
    top_is_b = F.col("by") > F.col("ay")
    queries = edges.select(
        "g",
        "w",
        F.struct(*EDGE, "n").alias("q"),
        # middles are multiples of half a step and so on no wall
        F.shiftright(F.col("ax") + F.col("bx"), 1).alias("px"),
        F.shiftright(F.col("ay") + F.col("by"), 1).alias("py"),
        F.when(top_is_b, F.col("bx")).otherwise(F.col("ax")).alias("tx"),
        F.when(top_is_b, F.col("by")).otherwise(F.col("ay")).alias("ty"),
    )
    # crossing an edge that runs up, from left to right, leaves what is on its left
    rightwards = F.when(F.col("up"), -F.col("n")).otherwise(F.col("n"))
    near = paths.from_corner(queries).select(
        "g", "q", F.when(F.col("leg") == 1, rightwards).otherwise(F.col("n")).alias("change")
    )
    placed = paths.placed(queries).select("g", "j", "i", "q")
    _, before = left_of_corner()
    corners = (
        paths.on_bottom_walls()
        .select("g", "j", "i", rightwards.alias("change"))
        .unionByName(placed.select("g", "j", "i", F.lit(0).cast("long").alias("change")))
        .groupBy("g", "j", "i")
        .agg(F.sum("change").alias("change"))
        .select("g", "j", "i", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("change"))
    )
    sides = (
        near.unionByName(placed.join(corners, ["g", "j", "i"]).select("g", "q", "change"))
        .groupBy("g", "q")
        .agg(F.sum("change").alias("number"))
        .select("g", "q.*", "number")
    )
    n = F.col("n")
    # the path ends on the left of edges that rise or lie flat, on the right of those that fall
    on_left = F.when(flat | top_is_b, F.col("number")).otherwise(F.col("number") + n)
    on_right = F.when(flat | top_is_b, F.col("number") - n).otherwise(F.col("number"))
    outline = sides.withColumn("l", on_left > 0).withColumn("r", on_right > 0).filter("l <> r")
    return outline.select(
        "g",
        *(F.when(F.col("l"), F.col(c)).otherwise(F.col(d)).alias(c)
          for c, d in zip(EDGE, ["bx", "by", "ax", "ay"], strict=True)),
    )


def union_outline(edges: DataFrame, group: list[str]) -> DataFrame:
    """Edges around the union of each group, the inside on their left.

    ``edges`` are the directed edges of all rings.  Overlaps, copies, touching areas and vertices in the middle
    of a neighbour's edge are all right; rows without a group fall out.  Besides the coordinates the
    outline has them in units of the layer's grid (``iax`` to ``iby``).  A vertex of the layer keeps
    its coordinates (the least of those that share a place of the grid), crossings lie on the grid.
    """
    kept = edges
    for c in group:
        kept = kept.filter(F.col(c).isNotNull())
    grid = grid_over(kept) or Grid(0.0, 0.0, 1.0)
    units = kept.select(
        F.struct(*group).alias("g"),
        *(F.col(c).alias(f"d{c}") for c in EDGE),
        *(grid.unit(F.col(c), grid.x if c.endswith("x") else grid.y).alias(c) for c in EDGE),
    )
    ahead = (F.col("ax") < F.col("bx")) | ((F.col("ax") == F.col("bx")) & (F.col("ay") < F.col("by")))

    def ends(names: list[str]) -> list[Column]:
        swapped = [*names[2:], *names[:2]]
        return [F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in zip(names, swapped, strict=True)]

    double = [f"d{c}" for c in EDGE]
    net = (
        units.filter("ax <> bx or ay <> by")
        .select("g", F.when(ahead, 1).otherwise(-1).alias("n"), *ends(EDGE), *ends(double))
        .groupBy("g", *EDGE)
        .agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in double))
        .filter("n <> 0")
        .transform(written, "overlay")
    )
    vertices = (
        net.select(F.inline(F.array(*(
            F.struct(*(F.col(p + c).alias(k) for p, c, k in (("", x, "vx"), ("", y, "vy"), ("d", x, "x"), ("d", y, "y"))))
            for x, y in (("ax", "ay"), ("bx", "by"))
        ))))
        .groupBy("vx", "vy")
        .agg(F.min("x").alias("x"), F.min("y").alias("y"))
    )
    outline = covered(noded(net.select("g", *EDGE, "n")))
    out = outline.select("g.*", *(F.col(c).alias(f"i{c}") for c in EDGE))
    for end in "ab":
        x, y = f"{end}x", f"{end}y"
        at = vertices.select(F.col("vx").alias(f"i{x}"), F.col("vy").alias(f"i{y}"),
                             F.col("x").alias(x), F.col("y").alias(y))
        out = out.join(at, [f"i{x}", f"i{y}"], "left").withColumns(
            {
                x: F.coalesce(x, grid.place(F.col(f"i{x}"), grid.x)),
                y: F.coalesce(y, grid.place(F.col(f"i{y}"), grid.y)),
            }
        )
    return out.select(*group, *EDGE, *(f"i{c}" for c in EDGE))
