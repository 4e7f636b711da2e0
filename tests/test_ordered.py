import random

from pyspark.sql import functions as F

from arealis.operators import ordered as O


def files(seed, n_files=30):
    """Random stub files; the first holds a third of all rows."""
    rng = random.Random(seed)
    rows = []
    for f in range(n_files):
        length = 400 if f == 0 else rng.randint(1, 30)
        stubs = ["Total:"]
        stubs += [rng.choice(["Male:", "Female:", "Under 5", "5 to 9", "White alone:"]) for _ in range(length)]
        rows += [(f"f{f}", i, s) for i, s in enumerate(stubs)]
    return rows


def loop_paths(rows):
    """The rule stated as a loop over one file."""
    out, path, opening, current = {}, [], True, None
    for f, i, stub in rows:
        if f != current:
            path, opening, current = [], True, f
        if ":" in stub:
            if not opening:
                path.pop()
            path.append(stub.replace(":", ""))
        else:
            opening = False
        name = "|".join(path)
        out[(f, i)] = name if ":" in stub else f"{name}|{stub}"
    return out


def test_stub_paths_match_the_loop(spark):
    for seed in range(3):
        rows = files(seed)
        df = spark.createDataFrame(rows, "f string, i int, stub string")
        got = O.stub_paths(df, ["f"], F.floor(F.col("i") / 7), F.col("i"), "stub")
        assert {(r.f, r.i): r.variable_extended_name for r in got.collect()} == loop_paths(rows)


def test_carry_forward_matches_a_loop(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.choice([None, None, f"v{i}"]), rng.choice([None, i])) for g in "abc" for i in range(200 if g == "a" else 20)]
    df = spark.createDataFrame(rows, "g string, i int, v string, w int")
    got = O.carry_forward(df, ["g"], F.floor(F.col("i") / 9), [F.col("i")], {"v": F.col("v"), "w": F.col("w")})
    want, last = {}, {}
    for g, i, v, w in rows:
        pv, pw = last.get(g, (None, None))
        last[g] = (v if v is not None else pv, w if w is not None else pw)
        want[(g, i)] = last[g]
    assert {(r.g, r.i): (r.v, r.w) for r in got.collect()} == want


def test_dense_row_number_on_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 50}", i * 7919 % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k int")
    got = O.dense_row_number(df, ["g"], ["k"], partitions=5).collect()
    for g in {r[0] for r in rows}:
        mine = sorted((r.k, r.row_number) for r in got if r.g == g)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))
    assert len(got) == 1000


def test_drop_last_rows(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "f string, i int")
    got = {(r.f, r.i) for r in O.drop_last_rows(df, ["f"], "i", 2).collect()}
    assert got == {("a", 0), ("a", 1), ("a", 2)}


def test_preferred(spark):
    df = spark.createDataFrame(
        [(1, "de", "d"), (1, "nl", "n"), (2, "es", "s"), (3, "en", "b"), (3, "en", "a")], "id int, lang string, t string"
    )
    got = df.groupBy("id").agg(O.preferred(F.col("t"), F.col("lang"), ["en", "fr", "de", "nl"], F.col("t")).alias("t"))
    assert {r.id: r.t for r in got.collect()} == {1: "d", 2: None, 3: "a"}


def test_latest_first_preview(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert {tuple(r) for r in O.latest_record(df, ["k"], ["t"]).select("k", "v").collect()} == {("a", "y"), ("b", "z")}
    assert {tuple(r) for r in O.first_record(df, ["k"], ["t"]).select("k", "v").collect()} == {("a", "x"), ("b", "z")}
    assert [r.v for r in O.preview(df, ["t", "k"], 2).collect()] == ["x", "z"]
