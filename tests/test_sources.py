import io
import json
import os
import zipfile
import zlib
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.sources import archives, boundaries, delimited, landed, nested, pages, triples, zips
from arealis.specs import DelimitedFormat
from workbench import scanning
from workbench.landing import crc32_joined, land_archive


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return buffer.getvalue()


@pytest.fixture(scope="module")
def landed_zips(tmp_path_factory):
    base = tmp_path_factory.mktemp("zips")
    (base / "one.zip").write_bytes(zipped({"anything.dat": "x"}))
    (base / "match.zip").write_bytes(zipped({"a-oa.csv": "h\n1\n", "a-lsoa.csv": "h\n2\n", "notes.txt": "n"}))
    (base / "slip.zip").write_bytes(zipped({"a-oa..csv": "h\n1\n", "notes.txt": "n"}))
    (base / "empty.zip").write_bytes(zipped({"a-oa.csv": "", "notes.txt": "n"}))
    (base / "bad.zip").write_bytes(b"not a zip")
    (base / "two.zip").write_bytes(zipped({"x.csv": "h\n1\n", "y.csv": "h\n2\n"}))
    return base


def by_name(df):
    return {r.archive.rsplit("/", 1)[-1]: (r.member, r.status) for r in df.collect()}


def test_member_picks(spark, landed_zips):
    files = archives.read_archives(spark, f"{landed_zips}/*.zip")
    members = archives.list_members(files)
    wanted = files.select("archive", F.lit("a-oa.csv").alias("wanted"))
    strict = by_name(archives.pick_members(members, wanted))
    assert strict == {
        "one.zip": ("anything.dat", "ok"), "match.zip": ("a-oa.csv", "ok"), "slip.zip": (None, "absent"),
        "empty.zip": ("a-oa.csv", "ok"), "bad.zip": (None, "malformed"), "two.zip": (None, "absent"),
    }
    lenient = by_name(archives.pick_members_with_fallback(members, wanted))
    assert lenient["slip.zip"] == ("a-oa..csv", "ok")
    assert lenient["empty.zip"][1] == "empty" and lenient["bad.zip"][1] == "malformed"
    by_suffix = by_name(archives.pick_members(members, files.select("archive", F.lit(".csv").alias("wanted"))))
    assert by_suffix["two.zip"] == (None, "absent")


def test_zip_members_are_listed_and_picked(spark, landed_zips):
    listed = zips.read_zip_members(spark, f"{landed_zips}/*.zip", content=False)
    wanted = listed.select("archive", F.lit("a-oa.csv").alias("wanted")).distinct()
    lenient = by_name(archives.pick_members_with_fallback(listed, wanted))
    assert lenient == {
        "one.zip": ("anything.dat", "ok"), "match.zip": ("a-oa.csv", "ok"), "slip.zip": ("a-oa..csv", "ok"),
        "empty.zip": ("a-oa.csv", "empty"), "bad.zip": (None, "malformed"), "two.zip": (None, "absent"),
    }


def test_only_wanted_members_are_unpacked(spark, tmp_path):
    """The bytes of the other member are broken: reading them would fail."""
    (tmp_path / "x.zip").write_bytes(zipped({"good.csv": "h\n1\n" * 100, "bad.csv": "k\n2\n" * 100}))
    with zipfile.ZipFile(tmp_path / "x.zip") as z:
        at = z.getinfo("bad.csv").header_offset
    raw = bytearray((tmp_path / "x.zip").read_bytes())
    raw[at + 37 : at + 45] = b"\xff" * 8
    (tmp_path / "x.zip").write_bytes(raw)
    good = zips.read_zip_members(spark, f"{tmp_path}/x.zip", member="good.csv")
    assert b"".join(r.content for r in good.collect()) == b"h\n1\n" * 100
    members = zips.read_zip_members(spark, f"{tmp_path}/*.zip")
    assert zips.read_zip_members(spark, f"{tmp_path}/*.zip", content=False).count() == 2
    with pytest.raises(Exception, match="CRC|decompress|invalid|Error"):
        members.collect()


CSV_TEXT = 'id,"the\nname",n\r\n1,"two\nlines, and ""quotes""",5\r\n\n2,short\n3,a,b,too,many\n4,x\u2028y,no number\n'


@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_csv_records_over_chunks(spark, monkeypatch, tmp_path, chunk):
    (tmp_path / "t.zip").write_bytes(zipped({"a.csv": CSV_TEXT, "empty.csv": "", "b.csv": 'h\n"open\n1\n', "c.csv": "x\n9\n"}))
    monkeypatch.setattr(zips, "CHUNK_BYTES", chunk)
    assert [x for x in zips._lines((CSV_TEXT.encode()[i : i + chunk] for i in range(0, 200, chunk)), "utf-8")] == [
        line + "\n" for line in CSV_TEXT.split("\n")[:-1]
    ]
    records = zips.csv_records(zips.read_zip_members(spark, f"{tmp_path}/t.zip"))
    found = {(r.member, r.record_no): r.fields for r in records.collect() if r.problem is None}
    assert found[("a.csv", 0)] == ["id", "the\nname", "n"]
    assert found[("a.csv", 1)] == ["1", 'two\nlines, and "quotes"', "5"]
    assert found[("a.csv", 4)] == ["4", "x\u2028y", "no number"]
    assert found[("c.csv", 1)] == ["9"]
    problems = {r.member: (r.n_records, r.n_malformed) for r in zips.record_problems(records).collect()}
    assert problems == {"a.csv": (4, 1), "b.csv": (1, 1), "c.csv": (1, 0)}
    table = zips.record_table(
        records.filter("member = 'a.csv'"), ["id", "name", "n"], lambda n: T.StringType() if n == "name" else T.LongType()
    )
    assert sorted(tuple(r) for r in table.collect()) == [
        (1, 'two\nlines, and "quotes"', 5), (2, "short", None), (4, "x\u2028y", None)
    ]


def test_table_members(spark):
    members = spark.createDataFrame([("z", "A1.csv"), ("z", "bulk_OUTPUT.csv"), ("z", "B2.csv")], "archive string, member string")
    index = spark.createDataFrame([("A1",), ("bulk_OUTPUT",)], "table_name string")
    assert [r.table_name for r in archives.table_members(members, index).collect()] == ["A1"]


def test_blank_headers(spark, tmp_path):
    from arealis.operators.columns import blank_header_columns

    (tmp_path / "t.csv").write_text(',,All people,Males\nS1,0 to 4,"1,234",-\n')
    df = blank_header_columns(spark.read.option("header", True).csv(str(tmp_path / "t.csv")))
    assert df.columns == ["GEO_ID", "key_0", "All people", "Males"]
    assert tuple(df.first()) == ("S1", "0 to 4", "1,234", "-")


def test_sheet_footer(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,1\nb,2\nc,3\nnote,\nsource,\n")
    got = delimited.read_sheet(spark, str(tmp_path / "s.csv"), ["code", "n"], footer_rows=2)
    assert [r.code for r in got.orderBy("code").collect()] == ["a", "b", "c"]


def test_encodings(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes('CD|NAME\n1|"Liège\n'.encode("latin-1"))
    path, schema = str(tmp_path / "t.txt"), "CD string, NAME string"
    got = delimited.read_with_encodings(spark, path, schema, ["UTF-8", "ISO-8859-1"])
    assert tuple(got.first()) == ("1", '"Liège')
    with pytest.raises(ValueError, match="none of"):
        delimited.read_with_encodings(spark, path, schema, ["UTF-8"])


def test_read_named(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "t.csv").write_text("a b;c.d\n01;2\n")
    got = delimited.read_named(
        spark, str(tmp_path / "t.csv"), lambda n: T.LongType() if n == "c.d" else T.StringType(), DelimitedFormat(";")
    )
    assert tuple(got.first()) == ("01", 2)


def test_formats(spark):
    with pytest.raises(ValueError, match="no reader for format MDB"):
        delimited.scan_by_format(delimited.FORMAT_ROOT + "MDB", {"TXT": lambda: None})


CATALOGUE = f"""
# a comment
<http://c> <{triples.DATASET}> <http://d/1> .
<http://d/1> <{triples.TITLE}> "Titre \\"un\\" \\\\n"@fr .
<http://d/1> <{triples.TITLE}> "Titel"@nl .
<http://d/1> <{triples.DISTRIBUTION}> <http://f/pop.zip?x=1> .
<http://f/pop.zip?x=1> <{triples.FORMAT}> <http://publications.europa.eu/resource/authority/file-type/TXT> .
<http://d/1> <{triples.DISTRIBUTION}> <http://f/pop.xlsx> .
<http://f/pop.xlsx> <{triples.FORMAT}> <http://publications.europa.eu/resource/authority/file-type/XLSX> .
<http://d/1> <{triples.LANDING_PAGE}> <http://p/nl> .
<http://d/1> <{triples.LANDING_PAGE}> <http://p/de> .
<http://p/nl> <{triples.LANGUAGE}> <http://l/NLD> .
<http://p/de> <{triples.LANGUAGE}> <http://l/DEU> .
<http://l/NLD> <{triples.NOTATION}> "nl"^^<{triples.ISO_639_1}> .
<http://l/DEU> <{triples.NOTATION}> "de"^^<{triples.ISO_639_1}> .
_:b0 <http://p> "plain" .
"""


def test_triples(spark, tmp_path):
    (tmp_path / "c.nt").write_text(CATALOGUE)
    graph = triples.read_triples(spark, str(tmp_path / "c.nt"))
    assert graph.count() == 14
    assert tuple(graph.filter("s = '_:b0'").first()) == ("_:b0", "http://p", "plain", None, None)
    assert triples.text_by_language(graph, triples.TITLE).first().text == 'Titre "un" \\n'
    assert triples.text_by_language(graph, triples.TITLE, "nl").first().text == "Titel"
    pick = triples.distributions(graph).first()
    assert (pick.url, pick.format, pick.member) == ("http://f/pop.zip?x=1", "TXT", "pop.txt")
    assert triples.landing_pages(graph, graph).first().page == "http://p/de"


def test_long_literals_do_not_overflow(spark):
    body = 'word \\" and \\n ' * 60_000
    line = f'<http://s> <http://p> "{body}"@en .'
    got = triples.parse_triple_lines(spark.createDataFrame([(line,)], "value string")).first()
    assert got.o == body.replace('\\"', '"').replace("\\n", "\n") and got.lang == "en"


PAGE = """
<html><body><div id="info"><h2>Title</h2><div>One<br>line</div><p>Two &amp; three</p></div>
<table><tr><th>a</th><th>b</th><th>c</th></tr><tr><td colspan="3">Sub</td></tr>
<tr><td>TS1</td><td>Sex <b>by</b> age</td><td><A HREF='/o/x.zip'>x.zip</a></td></tr>
<tr><td>TS2</td><td>Age</td><td></td></tr></table>
<a href="acs1.dat">acs1.dat</a><a class=x href="/en/standard?a">s</a><a href="readme">r</a></body></html>
"""


def test_pages(spark):
    df = spark.createDataFrame([("u", PAGE), ("v", "<p>no table</p>")], "url string, html string")
    assert [(r.pos, r.href) for r in pages.links(df).orderBy("pos").collect()] == [
        (0, "/o/x.zip"), (1, "acs1.dat"), (2, "/en/standard?a"), (3, "readme"),
    ]
    assert [r.name for r in pages.index_files(df).collect()] == ["acs1.dat"]
    cells = pages.named_cells(pages.table_rows(df), ["id", "about", "file"]).orderBy("row_no").collect()
    assert [(c.id.text, c.about.text, c.file.text, c.file.href) for c in cells] == [
        ("TS1", "Sex by age", "x.zip", "/o/x.zip"), ("TS2", "Age", "", None),
    ]
    assert pages.section_text(df.filter("url = 'u'"), "info").first().text == "Title\nOne\nline\nTwo & three"
    with pytest.raises(Exception, match="expected one section info, found 0 in v"):
        pages.section_text(df, "info").collect()


def test_nested(spark):
    document = {
        "Data": {
            "row": [
                {"rowNo": "1", "rowText": "Region", "columns": []},
                {"rowNo": "1.1", "rowText": "Town", "columns": [
                    {"key": "Males", "columns": [{"key": "Total", "value": "1,200"}, {"key": "0 - 4", "value": "-"}, {"key": "90 & Over", "value": "7"}]}
                ]},
            ]
        }
    }
    got = nested.subzone_population(spark.createDataFrame([(json.dumps(document),)], "value string"))
    assert {tuple(r) for r in got.collect()} == {
        ("TOWN", "Males", 0, None, 1200), ("TOWN", "Males", 0, 4, 0), ("TOWN", "Males", 90, None, 7),
    }


def test_features(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    features = [
        {"type": "Feature", "properties": {"id": 7, "n": None}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {"id": "8"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}},
    ]
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "s.geojsonseq").write_text("\n".join("\x1e" + json.dumps(f) for f in features))
    whole = boundaries.with_properties(boundaries.read_feature_collections(spark, str(tmp_path / "c.geojson")), ["id"])
    lines = boundaries.with_properties(boundaries.read_feature_lines(spark, str(tmp_path / "s.geojsonseq")), ["id"])
    for df in (whole, lines):
        assert {r.id: len(r.parts) for r in df.collect()} == {"7": 1, "8": 2}
    with pytest.raises(ValueError, match="extra: b"):
        boundaries.require_layers(spark.createDataFrame([("a",), ("b",)], "layer string"), ["a"])


def test_landed_files(spark, tmp_path):
    import hashlib

    (tmp_path / "a.bin").write_bytes(b"abc")
    files = landed.landed_files(spark, str(tmp_path / "a.bin"))
    row = files.first()
    assert row.size == 3 and row.sha256 == hashlib.sha256(b"abc").hexdigest()
    assert isinstance(row.modified, datetime)
    manifest = files.select(
        "path", F.col("sha256").alias("expected_sha256"), F.lit(3).cast("bigint").alias("expected_size"), F.lit(1).alias("refresh_days")
    ).unionByName(spark.createDataFrame([("gone", "x", 1, 1)], "path string, expected_sha256 string, expected_size bigint, refresh_days int"))
    assert {r.path.rsplit("/", 1)[-1]: r.status for r in landed.integrity(files, manifest).collect()} == {"a.bin": "ok", "gone": "missing"}
    later = landed.integrity(files, manifest, F.current_timestamp() + F.expr("interval 3 days"))
    assert {r.status for r in later.collect()} == {"stale", "missing"}


def test_triple_escapes_and_rejects(spark):
    text = [
        r'<http://a> <http://p> "caf\u00e9 \U0001F600 \\u0041 \b\f\' \"q\" \t" . # note',
        r'<http://caf\u00e9> <http://p> _:b1 .',
        r'_:b2 <http://p> "x . # y"^^<http://t> . # "z" .',
        r'<http://a> <http://p> "open .',
        r'<http://a> <http://p> "bad \x escape" .',
        r'<http://a> <http://p> "half \uD83D" .',
        "# only a comment",
        "   ",
        r'<http://a> <http://p> "' + r'\"' * 20_000 + '" .',
    ]
    lines = spark.createDataFrame([(t,) for t in text], "value string")
    found = {(r.s, r.o, r.datatype) for r in triples.parse_triple_lines(lines).collect()}
    assert found == {
        ("http://a", "caf\u00e9 \U0001F600 \\u0041 \b\f' \"q\" \t", None),
        ("http://caf\u00e9", "_:b1", None),
        ("_:b2", "x . # y", "http://t"),
        ("http://a", '"' * 20_000, None),
    }
    assert {r.value for r in triples.rejected_lines(lines).collect()} == set(text[3:6])


def test_members_are_handed_on_by_bytes(monkeypatch):
    monkeypatch.setattr(archives, "_CHUNK_BYTES", 10_000)
    landed = [zipped({f"{k}.csv": "x" * 3_000, f"{k}-b.csv": "y" * 50}) for k in range(20)] + [b"no archive", None]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([f"{k}.zip" for k in range(22)]), pa.array(landed, pa.binary())], names=["archive", "content"]
    )
    out = list(archives._members(True)(iter([batch])))
    assert len(out) > 5 and all(b.get_total_buffer_size() < 20_000 for b in out)
    rows = [row for b in out for row in b.to_pylist()]
    assert [(r["archive"], r["member"], r["size"], len(r["content"])) for r in rows[:2]] == [
        ("0.zip", "0.csv", 3_000, 3_000), ("0.zip", "0-b.csv", 50, 50)
    ]
    assert len(rows) == 42 and [r["problem"] for r in rows[-3:]] == [None, "malformed", "malformed"]


def test_landed_archives_are_handed_on_by_bytes(monkeypatch):
    monkeypatch.setattr(scanning, "_LANDED_BYTES", 10_000)
    texts = [os.urandom(1_500).hex() for _ in range(30)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(30)), pa.array(["en"] * 30), pa.array(["src2"] * 30), pa.array(texts)],
        names=["doc_id", "lang", "source", "text"],
    )
    out = list(scanning._zip_pages(iter([batch])))
    assert len(out) > 3 and all(b.get_total_buffer_size() < 20_000 for b in out)
    rows = [row for b in out for row in b.to_pylist()]
    assert [r["archive"] for r in rows] == [str(k) for k in range(30)]
    with zipfile.ZipFile(io.BytesIO(rows[29]["content"])) as z:
        assert z.read("table-29.csv").decode() == texts[29]


def test_crc32_of_strings_in_a_row():
    data = bytes(range(256)) * 5
    for cut in (0, 1, 700, len(data)):
        first, second = zlib.crc32(data[:cut]), zlib.crc32(data[cut:])
        assert crc32_joined(first, second, len(data) - cut) == zlib.crc32(data)


@pytest.mark.parametrize("n", [0, 1, 4_000])
def test_landed_members_are_packed_by_tasks(spark, monkeypatch, tmp_path, n):
    """The driver writes no member itself, and any reader of archives reads what it puts together."""
    lines = spark.range(0, n, 1, 5).selectExpr("lpad(id, 9, '0') as position", "concat(id, ',é\"x\ny\"') as line")
    written, write = [], zipfile.ZipFile.open
    monkeypatch.setattr(
        zipfile.ZipFile, "open", lambda z, x, mode="r", *a, **k: (written.append((x, mode)), write(z, x, mode, *a, **k))[1]
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land_archive(lines, f"{tmp_path}/new/x.zip", "t.csv")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [getattr(x, "filename", x) for x, mode in written if mode == "w"] == ["bulk_output.txt"]
    with zipfile.ZipFile(tmp_path / "new" / "x.zip") as z:
        assert z.testzip() is None and z.namelist() == ["t.csv", "bulk_output.txt"]
        assert z.getinfo("t.csv").compress_type == zipfile.ZIP_DEFLATED
        assert z.read("t.csv").decode() == "".join(f'{i},é"x\ny"\n' for i in range(n))
    chunks = zips.read_zip_members(spark, f"{tmp_path}/new/x.zip", member="t.csv").collect()
    assert b"".join(r.content for r in chunks).count(b"\n") == 2 * n
