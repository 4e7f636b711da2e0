import random
import struct

import pytest
from pyspark.sql import functions as F

from arealis.operators import geometry as G
from arealis.operators.overlay import _MAY_SPLIT, _split_points, in_cells
from arealis.specs import GeometryLevel


def square(x, y, size=1, clockwise=False):
    ring = [[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]
    return [[float(a), float(b)] for a, b in (ring[::-1] if clockwise else ring)]


SCHEMA = "g string, parts array<array<array<array<double>>>>"


def layer(spark, cells):
    """Unit squares; every other one is wound the other way."""
    return spark.createDataFrame(
        [(g, [[square(x, y, clockwise=(x + y) % 2 == 1)]]) for (x, y), g in cells.items()], SCHEMA
    )


def measure(spark, df):
    return {r.g: r.area for r in G.outline_measures(G.ring_edges(df, ["g"]), ["g"]).collect()}


def loop_rings(cells, g):
    """Number of edges around the cells of a group, counted one by one."""
    mine = {c for c, group in cells.items() if group == g}
    return sum((x + dx, y + dy) not in mine for x, y in mine for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1)))


@pytest.mark.parametrize("tile_edges", [200_000, 40])
def test_random_grid(spark, tile_edges):
    rng = random.Random(5)
    cells = {(x, y): rng.choice("ab") for x in range(7) for y in range(7)}
    shapes = G.dissolve(layer(spark, cells), "g", tile_edges=tile_edges)
    rows = {r.g: r.parts for r in shapes.collect()}
    assert measure(spark, shapes) == {g: float(list(cells.values()).count(g)) for g in "ab"}
    for g, parts in rows.items():
        assert sum(len(ring) - 1 for part in parts for ring in part) == loop_rings(cells, g)
        assert all(ring[0] == ring[-1] for part in parts for ring in part)


@pytest.mark.parametrize("tile_edges", [200_000, 40])
def test_hole_and_island(spark, tile_edges):
    ring = {(x, y): "ring" for x in range(7) for y in range(7) if not (1 <= x <= 5 and 1 <= y <= 5)}
    island = {(x, y): "ring" for x in (3,) for y in (3,)}
    filler = {(x, y): "in" for x in range(1, 6) for y in range(1, 6) if (x, y) != (3, 3)}
    rows = {r.g: r.parts for r in G.dissolve(layer(spark, {**ring, **island, **filler}), "g", tile_edges=tile_edges).collect()}
    assert sorted(len(p) for p in rows["ring"]) == [1, 2]
    assert [len(p) for p in rows["in"]] == [2]
    assert len(rows["in"][0][0]) > len(rows["in"][0][1])


def test_copies_change_nothing(spark):
    cells = {(x, y): "a" for x in range(3) for y in range(3)}
    df = layer(spark, cells)
    some = df.limit(4)
    once = G.outline_measures(G.dissolve_edges(G.ring_edges(df, ["g"]), ["g"]), ["g"]).first()
    copied = df.unionByName(df).unionByName(some)
    again = G.outline_measures(G.dissolve_edges(G.ring_edges(copied, ["g"]), ["g"]), ["g"]).first()
    assert once == again and once.area == 9.0 and once.n_edges == 12


def test_null_keys_fall_out_and_first_attribute(spark):
    df = spark.createDataFrame(
        [("a", [[square(0, 0)]], None, 1), ("a", [[square(1, 0)]], "second", 2), (None, [[square(2, 0)]], "x", 3)],
        "g string, parts array<array<array<array<double>>>>, name string, i int",
    )
    rows = G.dissolve(df, "g", ["name"], "i").collect()
    assert [(r.g, r.name) for r in rows] == [("a", "second")]


def test_levels_and_names(spark):
    df = spark.createDataFrame(
        [("1", [[square(0, 0)]], "een"), ("1", [[square(1, 0)]], "een"), ("2", [[square(2, 0)]], "twee")],
        "cd string, parts array<array<array<array<double>>>>, tx string",
    )
    level = GeometryLevel("x", "adm1", "cd", {"nld": "tx"})
    assert G.level_boundaries(df, level).columns == ["GEO_ID", "parts"]
    assert {tuple(r) for r in G.level_names(df, level).collect()} == {("1", "een"), ("2", "twee")}


def test_wkb_and_geojson(spark):
    import json

    df = spark.createDataFrame([("a", [[square(0, 0)]]), ("b", [[square(0, 0)], [square(5, 5)]])], SCHEMA)
    rows = {r.g: r for r in df.select("g", G.to_wkb("parts").alias("w"), G.geojson_feature(F.col("parts"), {"GEO_ID": F.col("g")}).alias("j")).collect()}
    assert struct.unpack_from("<BII", rows["b"].w) == (1, 6, 2)
    assert len(rows["a"].w) == 9 + 9 + 4 + 5 * 16
    feature = json.loads(rows["a"].j)
    assert feature["geometry"]["type"] == "Polygon" and feature["properties"] == {"GEO_ID": "a"}
    assert json.loads(rows["b"].j)["geometry"]["type"] == "MultiPolygon"


def rect(x0, y0, x1, y1):
    return [[float(a), float(b)] for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]


def area_of(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def unmatched_layer():
    """Areas that overlap, touch, or have a vertex in the middle of a neighbour's edge."""
    rows = [("t", rect(0, 0, 2, 2)), ("t", rect(2, 0, 3, 1)), ("t", rect(2, 1, 3, 2))]
    rows += [("over", rect(0, 0, 2, 1)), ("over", rect(1, 0, 3, 1))]
    rows += [("cross", rect(0, 1, 3, 2)), ("cross", rect(1, 0, 2, 3))]
    rows += [("inner", rect(0, 0, 9, 9)), ("inner", rect(3, 3, 4, 4))]
    rows += [("touch", rect(x, y, x + 1, y + 1)) for x in range(4) for y in range(4) if (x, y) not in ((1, 1), (0, 2))]
    isle = [(x, y) for x in range(7) for y in range(7) if not (1 <= x <= 5 and 1 <= y <= 5) or (x, y) == (3, 3)]
    rows += [("isle", rect(x, y, x + 1, y + 1)) for x, y in isle]
    rows += [("tri", [[0.0, 0.0], [4.0, 0.0], [2.0, 4.0], [0.0, 0.0]]), ("tri", [[0.0, 3.0], [2.0, -1.0], [4.0, 3.0], [0.0, 3.0]])]
    rng, cover = random.Random(2), set()
    for _ in range(14):
        x, y, w, h = rng.randrange(12), rng.randrange(12), rng.randrange(1, 6), rng.randrange(1, 6)
        rows.append(("many", rect(x, y, x + w, y + h)))
        cover |= {(i, j) for i in range(x, x + w) for j in range(y, y + h)}
    out = [(g, [[ring]]) for g, ring in rows]
    out.append(("holes", [[rect(0, 0, 61, 3), *(rect(2 * k + 1, 1, 2 * k + 2, 2)[::-1] for k in range(30))]]))
    return out, cover


def test_union_of_unmatched_areas_is_the_same_for_every_tile(spark):
    rows, cover = unmatched_layer()
    df = spark.createDataFrame(rows, SCHEMA)
    found = []
    for tile_edges in (200_000, 30):
        parts = {r.g: r.parts for r in G.dissolve(df, "g", tile_edges=tile_edges).collect()}
        found.append(parts)
        areas = {g: sum(area_of(ring) for part in p for ring in part) for g, p in parts.items()}
        assert areas == pytest.approx(
            {"t": 6, "over": 3, "cross": 5, "inner": 81, "touch": 14, "isle": 25, "tri": 10.75, "many": len(cover), "holes": 153}
        )
        shape = {g: sorted(len(part) for part in p) for g, p in parts.items()}
        assert shape.pop("many") == [1] * len(parts["many"])
        assert shape == {
            "t": [1], "over": [1], "cross": [1], "inner": [1], "touch": [2], "isle": [1, 2], "tri": [1], "holes": [31]
        }
        for p in parts.values():
            for outer, *holes in p:
                assert area_of(outer) > 0 and all(area_of(h) < 0 for h in holes)
                for ring in (outer, *holes):
                    assert ring[0] == ring[-1] and len({tuple(q) for q in ring}) == len(ring) - 1
    assert found[0] == found[1]


def test_open_outline_names_its_area(spark):
    edges = spark.createDataFrame([("lost", 0.0, 0.0, 1.0, 0.0), ("lost", 1.0, 0.0, 1.0, 1.0)], "g string, ax double, ay double, bx double, by double")
    with pytest.raises(Exception, match="do not close around .*lost"):
        G.build_rings(edges, ["g"]).collect()


def test_nothing_dissolves_to_nothing(spark):
    assert G.dissolve(spark.createDataFrame([], SCHEMA), "g").collect() == []


def test_edges_along_an_axis_lie_in_the_cells_they_touch(spark):
    edges = spark.createDataFrame(
        [("a", 0, 8, 8, 8, 8), ("b", 8, 0, 8, 8, 8), ("c", 0, 0, 8, 8, 8)],
        "g string, ax long, ay long, bx long, by long, w long",
    )
    cells = {g: {(r.i, r.j) for r in in_cells(edges).filter(F.col("g") == g).collect()} for g in "abc"}
    assert cells["a"] == {(-1, 0), (0, 0)}
    assert cells["b"] == {(0, -1), (0, 0)}
    assert {(-1, -1), (0, 0)} <= cells["c"]


def test_split_points_of_all_pairs(spark):
    """Against every pair, with common ends, crossings, ends inside edges and edges on top of each other."""
    draw = random.Random(5)
    edges = set()
    while len(edges) < 60:
        a, b = sorted(((4 * draw.randrange(7), 4 * draw.randrange(7)) for _ in range(2)))
        if a != b:
            edges.add((*a, *b))

    def side(e, x, y):
        return (e[2] - e[0]) * (y - e[1]) - (e[3] - e[1]) * (x - e[0])

    def within(e, x, y):
        box = e[0] <= x <= e[2] and min(e[1], e[3]) <= y <= max(e[1], e[3])
        return box and (x, y) not in (e[:2], e[2:])

    ends, cut = set(), set()
    for s in edges:
        for t in edges - {s}:
            ends |= {(s, *p) for p in (t[:2], t[2:]) if side(s, *p) == 0 and within(s, *p)}
            sa, sb = side(t, *s[:2]), side(t, *s[2:])
            if s < t and side(s, *t[:2]) * side(s, *t[2:]) < 0 and sa * sb < 0:
                share = sa / (sa - sb)
                at = tuple(round((s[k] + share * (s[k + 2] - s[k])) / 4) * 4 for k in (0, 1))
                cut |= {(e, *at) for e in (s, t) if within(e, *at)}
    frame = spark.createDataFrame(
        [("g", *e, 1) for e in edges], "g string, ax long, ay long, bx long, by long, n long"
    )
    found = {(tuple(r.e), r.px, r.py) for r in _split_points(frame).collect()}
    assert found == ends | cut
    assert len(cut) > 50 and len(ends) > 10


def test_split_pairs_that_only_share_an_end_go_no_further(spark):
    edges = [(0, 0, 4, 0), (0, 0, 0, 4), (4, 0, 4, 4), (4, 0, 8, 0), (0, 0, 8, 0), (0, 0, 4, 8)]
    pairs = spark.createDataFrame(
        [(*s, *t) for s in edges for t in edges], "ax long, ay long, bx long, by long, cx long, cy long, dx long, dy long"
    )
    kept = {(tuple(r)[:4], tuple(r)[4:]) for r in pairs.filter(_MAY_SPLIT).collect()}
    # one edge on top of another, an end on another edge, and boxes that meet
    assert kept == {
        ((0, 0, 4, 0), (0, 0, 8, 0)), ((0, 0, 8, 0), (4, 0, 8, 0)), ((0, 0, 8, 0), (4, 0, 4, 4)), ((0, 0, 4, 8), (4, 0, 4, 4)),
        ((0, 0, 4, 8), (4, 0, 8, 0)),
    }
