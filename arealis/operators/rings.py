"""Rings from outline edges, and the outer ring of every hole, without a task that holds a whole area.

Every edge is linked to the edge that bounds the same covered sector at its end.  Links are followed
inside spatial tiles first, which leaves chains; chains are numbered by pointer doubling.  A walk that comes
through a point more than once is cut there, so rings touch themselves nowhere.  The outcome does not depend on
the tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.operators.overlay import EDGE, CellPaths, cell_widths, grid_over, left_of_corner
from arealis.session import written

#: Edges that a task follows at once.
TILE_EDGES = 200_000

_NAME = ["r_ax", "r_ay", "r_bx", "r_by"]


def with_units(outline: DataFrame) -> DataFrame:
    """The outline with coordinates in grid units, if it has none yet."""
    if "iax" in outline.columns:
        return outline
    grid = grid_over(outline)
    if grid is None:
        return outline.withColumns({f"i{c}": F.lit(0).cast("long") for c in EDGE})
    return outline.withColumns(
        {f"i{c}": grid.unit(F.col(c), grid.x if c.endswith("x") else grid.y) for c in EDGE}
    )


def _links(edges: DataFrame) -> DataFrame:
    """(g, e, next): each edge with the next one around the covered side; e and next are structs.

    Around a vertex covered sectors lie between an edge that comes in and the next one, clockwise, that
    goes out.  A vertex at which this is not so raises an error that names the area.
    """
    here = edges.select(
        "g",
        F.inline(
            F.array(
                F.struct(F.col("e.bx").alias("vx"), F.col("e.by").alias("vy"), F.lit(True).alias("comes"), "e",
                         F.atan2((F.col("e.ay") - F.col("e.by")).cast("double"), (F.col("e.ax") - F.col("e.bx")).cast("double")).alias("angle")),
                F.struct(F.col("e.ax").alias("vx"), F.col("e.ay").alias("vy"), F.lit(False).alias("comes"), "e",
                         F.atan2((F.col("e.by") - F.col("e.ay")).cast("double"), (F.col("e.bx") - F.col("e.ax")).cast("double")).alias("angle")),
            )
        ),
    )
    around = Window.partitionBy("g", "vx", "vy")
    turn = around.orderBy(F.col("angle").desc(), "comes")
    follower = F.struct("comes", "e")
    paired = here.withColumn(
        "f", F.coalesce(F.lead(follower).over(turn), F.first(follower).over(turn))
    ).withColumn("even", F.sum(F.when(F.col("comes"), 1).otherwise(-1)).over(around) == 0)
    broken = F.raise_error(
        F.concat(F.lit("edges do not close around "), F.col("g"), F.lit(" at "), F.to_json(F.struct("vx", "vy")))
    )
    sound = F.col("even") & (~F.col("comes") | ~F.col("f.comes"))
    return (
        paired.withColumn("sound", F.when(sound, True).otherwise(broken.cast("boolean")))
        .filter("sound and comes")
        .select("g", "e", F.col("f.e").alias("next"))
    )


def _spread(value: Column) -> Column:
    """Bits of a number below 2**31 with a gap after each."""
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def _chains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follow the links of a tile: per edge its chain's first edge and its place in the chain."""
    frames = list(batches)
    if not frames:
        return
    tile = pd.concat(frames, ignore_index=True)
    place = {edge: k for k, edge in enumerate(zip(tile["g"], *(tile[c] for c in EDGE), strict=True))}
    ahead = np.array(
        [place.get(key, -1) for key in zip(tile["g"], *(tile[f"n_{c}"] for c in EDGE), strict=True)], np.int64
    )
    n = len(tile)
    has_before = np.zeros(n, bool)
    has_before[ahead[ahead >= 0]] = True
    first, at = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    last = np.full(n, -1, np.int64)
    # open chains from their first edges, then closed ones from any edge
    for starts in (np.flatnonzero(~has_before), range(n)):
        for start in starts:
            if first[start] >= 0:
                continue
            k, steps = int(start), 0
            while k >= 0 and first[k] < 0:
                first[k], at[k] = start, steps
                tail, k, steps = k, int(ahead[k]), steps + 1
            last[start] = tail if k < 0 else -1  # -1: the chain closes on itself
    out = tile[["g", *EDGE]].copy()
    for c in EDGE:
        out[f"h_{c}"] = tile[c].to_numpy()[first]
    out["at"] = at
    tail = last[first]
    out["closed"] = tail < 0
    for c in EDGE:
        out[f"t_{c}"] = tile[f"n_{c}"].to_numpy()[np.maximum(tail, 0)]
    yield out


def _struct(prefix: str = "") -> Column:
    return F.struct(*(F.col(prefix + c).alias(c) for c in EDGE))


def _walks(links: DataFrame, total: int, tile_edges: int) -> DataFrame:
    """(g, e, low, seq, n): each edge, the smallest edge of its walk, its place from there, the walk's length."""
    rows = links.select(
        "g",
        *(F.col(f"e.{c}").alias(c) for c in EDGE),
        *(F.col(f"next.{c}").alias(f"n_{c}") for c in EDGE),
    )
    curve = _spread(F.col("ax")).bitwiseOR(F.shiftleft(_spread(F.col("ay")), 1))
    # the curve first: small areas share a tile, and no area needs one for itself
    tiles = rows.repartitionByRange(max(1, -(-total // tile_edges)), curve, "g", *EDGE)
    names = ["g string", *(f"{c} long" for c in EDGE), *(f"h_{c} long" for c in EDGE), "at long",
             "closed boolean", *(f"t_{c} long" for c in EDGE)]
    followed = tiles.mapInPandas(_chains, ", ".join(names)).select(
        "g", _struct().alias("e"), _struct("h_").alias("head"), "at", "closed", _struct("t_").alias("then")
    ).transform(written, "rings")
    chains = (
        followed.groupBy("g", "head")
        .agg(
            F.min("e").alias("low"),
            F.count(F.lit(1)).alias("size"),
            F.max("closed").alias("closed"),
            F.min("then").alias("then"),
        )
        .transform(written, "rings")
    )
    placed = chains.filter("closed").select(
        "g", "head", "low", F.col("size").alias("n"), F.lit(0).cast("long").alias("offset")
    )
    left_open = chains.filter("not closed").select("g", "head", "low", "size", "then")
    if not left_open.isEmpty():
        placed = placed.unionByName(_offsets(left_open))
    numbered = followed.select("g", "e", "head", "at").join(placed, ["g", "head"]).withColumn(
        "place", F.col("offset") + F.col("at")
    )
    zero = numbered.filter("e = low").select("g", "low", F.col("place").alias("zero"))
    return numbered.join(zero, ["g", "low"]).select(
        "g", "e", "low", F.pmod(F.col("place") - F.col("zero"), F.col("n")).alias("seq"), "n"
    )


def _offsets(chains: DataFrame) -> DataFrame:
    """(g, head, low, n, offset): smallest edge and length of each chain's walk, and the chain's place in it."""
    # the smallest edge of every walk, looking twice as far ahead each time
    jump = chains.select("g", "head", "then", "low")
    while True:
        other = jump.select("g", F.col("head").alias("then"), F.col("then").alias("further"), F.col("low").alias("far"))
        stepped = jump.join(other, ["g", "then"]).select(
            "g", "head", F.col("further").alias("then"), F.least("low", "far").alias("low"),
            (F.col("far") < F.col("low")).alias("moved"),
        ).transform(written, "rings")
        jump = stepped.drop("moved")
        if stepped.filter("moved").isEmpty():
            break
    named = chains.select("g", "head", "then", "size", F.col("low").alias("own_low")).join(
        jump.select("g", "head", "low"), ["g", "head"]
    )
    # the walk begins with the chain that holds its smallest edge; what is left from each chain on
    begins = named.filter("own_low = low").select("g", "low", F.col("head").alias("begin"))
    rank = named.join(begins, ["g", "low"]).select(
        "g", "head", "low",
        F.when(F.col("then") != F.col("begin"), F.col("then")).alias("then"),
        F.col("size").alias("left"), "size",
    ).transform(written, "rings")
    while not rank.filter(F.col("then").isNotNull()).isEmpty():
        other = rank.select("g", F.col("head").alias("then"), F.col("then").alias("further"), F.col("left").alias("far"))
        rank = rank.join(other, ["g", "then"], "left").select(
            "g", "head", "low", F.col("further").alias("then"),
            (F.col("left") + F.coalesce("far", F.lit(0))).alias("left"), "size",
        ).transform(written, "rings")
    length = rank.groupBy("g", "low").agg(F.sum("size").alias("n"))
    return rank.join(length, ["g", "low"]).select(
        "g", "head", "low", "n", (F.col("n") - F.col("left")).alias("offset")
    )


def _cut(walks: DataFrame) -> DataFrame:
    """Links that make a ring of every part of a walk between two visits of a point."""
    before = walks.select(
        "g", "low", F.pmod(F.col("seq") + 1, F.col("n")).alias("seq"), F.col("e").alias("comes")
    )
    visits = walks.join(before, ["g", "low", "seq"])
    point = Window.partitionBy("g", "low", "e.ax", "e.ay")
    order = point.orderBy("seq")
    goes = F.coalesce(
        F.lag("e").over(order),
        F.last("e").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    return visits.select("g", F.col("comes").alias("e"), goes.alias("next"))


def build_rings(outline: DataFrame, group: list[str], tile_edges: int = TILE_EDGES) -> DataFrame:
    """Rings of each area as points ``(r_ax, r_ay, r_bx, r_by, seq, x, y)`` and ``ix, iy`` in grid units.

    A ring is named after its smallest edge, its first; the last point is not repeated.  ``outline`` has
    directed edges with the covered side on their left; copies count once.
    """
    edges = (
        with_units(outline)
        .select(
            F.struct(*group).alias("area_of"),
            F.struct(*(F.col(f"i{c}").alias(c) for c in EDGE)).alias("e"),
            F.struct(*EDGE).alias("d"),
        )
        .groupBy("area_of", "e")
        .agg(F.min("d").alias("d"))
        # areas go through the tiles as text, which is only compared
        .withColumn("g", F.to_json("area_of"))
        .transform(written, "rings")
    )
    total = edges.count()
    walks = _walks(_links(edges), total, tile_edges).transform(written, "rings")
    twice = walks.groupBy("g", "low", "e.ax", "e.ay").count().filter("count > 1")
    if not twice.isEmpty():
        walks = _walks(_cut(walks), total, tile_edges).transform(written, "rings")
    points = walks.join(edges, ["g", "e"])
    names = points.filter("seq = 0").select("g", "low", F.col("d").alias("name"))
    return points.join(names, ["g", "low"]).select(
        "area_of.*",
        *(F.col(f"name.{c}").alias(r) for c, r in zip(EDGE, _NAME, strict=True)),
        F.col("seq").cast("int").alias("seq"),
        F.col("d.ax").alias("x"), F.col("d.ay").alias("y"),
        F.col("e.ax").alias("ix"), F.col("e.ay").alias("iy"),
    )


def outer_rings(rings: DataFrame, group: list[str]) -> DataFrame:
    """(group, ring, part): the outer ring around every ring, itself for outer ones.

    ``rings`` has ``ring`` (a struct that names it), ``is_hole`` and ``grid_points`` (open, in units).  Below the
    lowest point of a hole the path to its left meets a ring of the same part: the outer one, or a hole that
    lies lower or further to the left, whose own path goes on.  Following them is pointer doubling again.
    """
    packed = rings.select(
        F.struct(*group).alias("g"), "ring", "is_hole", F.col("grid_points").alias("p")
    ).transform(written, "rings")
    following = F.concat(F.slice("p", 2, F.size("p") - 1), F.slice("p", 1, 1))
    sides = packed.select(
        "g", "ring", "is_hole",
        F.inline(F.zip_with("p", following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))),
    )
    ahead = F.col("a") < F.col("b")
    low, high = F.when(ahead, F.col("a")).otherwise(F.col("b")), F.when(ahead, F.col("b")).otherwise(F.col("a"))
    edges = sides.select(
        "g", "ring", low["x"].alias("ax"), low["y"].alias("ay"), high["x"].alias("bx"), high["y"].alias("by")
    )
    widths = cell_widths(edges)
    paths = CellPaths(edges.join(widths, "g"))
    # the lowest point of each hole, the leftmost of several, and the end of its left edge there
    lowest = F.array_min(F.transform("p", lambda q: F.struct(q["y"].alias("y"), q["x"].alias("x"))))
    holes = packed.filter("is_hole").select("g", "ring", lowest.alias("v"))
    at_lowest = holes.join(sides.select("g", "ring", "a", "b"), ["g", "ring"]).select(
        "g", "ring", "v",
        F.when((F.col("a.x") == F.col("v.x")) & (F.col("a.y") == F.col("v.y")), F.col("b"))
        .when((F.col("b.x") == F.col("v.x")) & (F.col("b.y") == F.col("v.y")), F.col("a"))
        .alias("tip"),
    ).filter("tip is not null")
    lean = (F.col("tip.x") - F.col("v.x")).cast("double") / F.when(
        F.col("tip.y") > F.col("v.y"), (F.col("tip.y") - F.col("v.y")).cast("double")
    )
    queries = at_lowest.groupBy("g", F.col("ring").alias("q"), "v").agg(
        F.min_by("tip", F.coalesce(lean, F.lit(float("inf")))).alias("tip")
    ).select(
        "g", "q", F.col("v.x").alias("px"), F.col("v.y").alias("py"), F.col("tip.x").alias("tx"), F.col("tip.y").alias("ty")
    )
    queries = queries.join(widths, "g")
    # the last edge of a path: to the right before up the wall, then the row of corners
    met = paths.from_corner(queries).groupBy("g", "q").agg(
        F.max_by("ring", F.struct("leg", "at", "lean")).alias("near")
    )
    walls = paths.on_bottom_walls().groupBy("g", "j", "i").agg(F.max_by("ring", "at").alias("ring"))
    asked = paths.placed(queries).select("g", "q", "i", "j")
    _, before = left_of_corner()
    none = F.lit(None).cast(walls.schema["ring"].dataType)
    corners = (
        walls.unionByName(asked.select("g", "j", "i").distinct().withColumn("ring", none))
        .groupBy("g", "j", "i")
        .agg(F.max("ring").alias("ring"))
        .withColumn("far", F.last("ring", ignorenulls=True).over(before))
        .drop("ring")
    )
    kinds = packed.select("g", F.col("ring").alias("up"), F.col("is_hole").alias("up_is_hole"))
    links = (
        asked.join(corners, ["g", "j", "i"], "left")
        .join(met, ["g", "q"], "left")
        .select("g", F.col("q").alias("ring"), F.coalesce("near", "far").alias("up"))
        .join(kinds, ["g", "up"], "left")
        .transform(written, "rings")
    )
    lost = F.raise_error(F.concat(F.lit("a hole without a ring around it in "), F.to_json("g")))
    links = links.withColumn(
        "up", F.when(F.col("up").isNull(), lost.cast(links.schema["up"].dataType)).otherwise(F.col("up"))
    )
    while not links.filter("up_is_hole").isEmpty():
        other = links.select("g", F.col("ring").alias("up"), F.col("up").alias("further"), F.col("up_is_hole").alias("more"))
        links = links.join(other, ["g", "up"], "left").select(
            "g", "ring", F.coalesce("further", "up").alias("up"), F.coalesce("more", F.lit(False)).alias("up_is_hole")
        ).transform(written, "rings")
    outer = packed.filter("not is_hole").select("g", "ring", F.col("ring").alias("part"))
    return outer.unionByName(links.select("g", "ring", F.col("up").alias("part"))).select("g.*", "ring", "part")
