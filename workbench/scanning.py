"""Scans: each query lands files or documents made from a table, then reads them."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from arealis.operators.columns import blank_header_columns
from arealis.operators.geometry import (
    assign_holes,
    build_rings,
    dissolve,
    dissolve_edges,
    geojson_feature,
    outline_measures,
    ring_edges,
    ring_table,
    to_wkb,
)
from arealis.session import scratch_path
from arealis.sources import archives as A
from arealis.sources import boundaries as B
from arealis.sources import delimited as D
from arealis.sources import landed as L
from arealis.sources import nested as N
from arealis.sources import pages as P
from arealis.sources import triples as R
from arealis.specs import DelimitedFormat
from workbench.base import query, table


@query("csv_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    columns = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    columns.write.option("header", True).csv(path)
    return D.read_delimited(spark, path, columns.schema)


@query(
    "delimited_scan_latin1",
    """SELECT CAST(doc_id AS VARCHAR) AS "GEO_ID", 'Zoné ' || lang || '; ' || source AS "NAME", n_chars AS "SUMLEVEL" FROM documents""",
)
def delimited_scan_latin1(spark, sf):
    path = scratch_path(spark, "latin1")
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("GEO_ID"),
        F.concat(F.lit("Zoné "), "lang", F.lit("; "), "source").alias("NAME"),
        F.col("n_chars").alias("SUMLEVEL"),
    )
    rows.write.option("sep", "|").option("encoding", "ISO-8859-1").option("header", True).csv(path)
    return D.read_delimited(spark, path, rows.schema, DelimitedFormat("|", "ISO-8859-1"))


@query(
    "encoding_candidates",
    """SELECT CAST(doc_id AS VARCHAR) AS "CD_SECTOR", '"é' || source AS "NAME" FROM documents""",
)
def encoding_candidates(spark, sf):
    path = scratch_path(spark, "encodings")
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("CD_SECTOR"), F.concat(F.lit('"é'), "source").alias("NAME")
    )
    lines = rows.select(F.concat_ws("|", "CD_SECTOR", "NAME").alias("value"))
    lines.write.option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "").option("emptyValue", "").csv(path)
    fmt = DelimitedFormat("|", quoted=False, header=False)
    return D.read_with_encodings(spark, path, rows.schema, ["UTF-8", "ISO-8859-1"], fmt)


@query(
    "blank_header_scan",
    """SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS "GEO_ID", c_mktsegment AS key_0, CAST(count(*) AS VARCHAR) AS key_1
    FROM customer GROUP BY 1, 2""",
)
def blank_header_scan(spark, sf):
    path = scratch_path(spark, "crosstab")
    counted = table(spark, sf, "customer").groupBy(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("g"), "c_mktsegment"
    ).agg(F.count("*").alias("n"))
    counted.write.csv(path)
    return blank_header_columns(spark.read.csv(path))


@query(
    "sheet_scan",
    """SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM (SELECT c_custkey, c_name,
      row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey DESC) AS rn FROM customer) WHERE rn > 2""",
)
def sheet_scan(spark, sf):
    path = scratch_path(spark, "sheets")
    sheets = table(spark, sf, "customer").select("c_custkey", "c_name", F.expr("c_custkey div 500").alias("sheet"))
    # A sheet is one file of at most 500 rows; its last two lines are the footer.
    sheets.repartition("sheet").sortWithinPartitions("sheet", "c_custkey").write.partitionBy("sheet").csv(path)
    return D.read_sheet(spark, f"{path}/*", ["code", "name"], footer_rows=2)


#: Bytes of archives that go on at once.
_LANDED_BYTES = 4 << 20


def _zip_page(number, lang, source, text) -> bytes:
    if source == "src0":
        return b"no archive"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        if lang == "de":
            z.writestr(f"only-{number}.dat", text)
        elif lang == "fr":
            z.writestr(f"table-{number}..csv", text)
            z.writestr("notes.md", source)
        elif lang == "es":
            z.writestr(f"table-{number}.csv", "")
            z.writestr("notes.md", source)
        elif source == "src1":
            z.writestr("bulk_output.md", source)
            z.writestr("notes.md", source)
        else:
            z.writestr(f"table-{number}.csv", text)
            z.writestr("bulk_output_1.csv.md", source)
    return buffer.getvalue()


def _zip_pages(batches):
    """Archives of documents, packed one by one and handed on by bytes."""

    def batch(held):
        names, contents = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(contents, pa.binary())], names=["archive", "content"]
        )

    held, size = [], 0
    for rows in batches:
        for row in zip(*rows.columns, strict=True):
            number, lang, source, text = (cell.as_py() for cell in row)
            held.append((str(number), _zip_page(number, lang, source, text)))
            size += len(held[-1][1]) + 64
            if size >= _LANDED_BYTES:
                yield batch(held)
                held, size = [], 0
    if held:
        yield batch(held)


def landed_archives(spark, sf):
    """One zip per document: whole, single-member, misnamed, empty or malformed."""
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return documents.mapInArrow(_zip_pages, "archive string, content binary")


_KIND = """CASE WHEN source = 'src0' THEN 'bad' WHEN lang = 'de' THEN 'only' WHEN lang = 'fr' THEN 'slip'
  WHEN lang = 'es' THEN 'empty' WHEN source = 'src1' THEN 'none' ELSE 'whole' END"""


def _wanted(spark, sf):
    name = F.concat(F.lit("table-"), F.col("doc_id").cast("string"), F.lit(".csv"))
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("archive"), name.alias("wanted"))


@query(
    "archive_member_pick",
    f"""WITH k AS (SELECT CAST(doc_id AS VARCHAR) AS archive, {_KIND} AS kind FROM documents)
    SELECT archive, 'table-' || archive || '.csv' AS wanted, CASE kind WHEN 'only' THEN 'only-' || archive || '.dat'
      WHEN 'whole' THEN 'table-' || archive || '.csv' WHEN 'empty' THEN 'table-' || archive || '.csv' END AS member,
      CASE kind WHEN 'bad' THEN 'malformed' WHEN 'slip' THEN 'absent' WHEN 'none' THEN 'absent' ELSE 'ok' END AS status FROM k""",
)
def archive_member_pick(spark, sf):
    return A.pick_members(A.list_members(landed_archives(spark, sf)), _wanted(spark, sf))


@query(
    "archive_member_fallback",
    f"""WITH k AS (SELECT CAST(doc_id AS VARCHAR) AS archive, {_KIND} AS kind FROM documents)
    SELECT archive, 'table-' || archive || '.csv' AS wanted, CASE kind WHEN 'only' THEN 'only-' || archive || '.dat'
      WHEN 'slip' THEN 'table-' || archive || '..csv' WHEN 'whole' THEN 'table-' || archive || '.csv'
      WHEN 'empty' THEN 'table-' || archive || '.csv' END AS member,
      CASE kind WHEN 'bad' THEN 'malformed' WHEN 'none' THEN 'absent' WHEN 'empty' THEN 'empty' ELSE 'ok' END AS status FROM k""",
)
def archive_member_fallback(spark, sf):
    return A.pick_members_with_fallback(A.list_members(landed_archives(spark, sf)), _wanted(spark, sf))


@query(
    "archive_tables",
    f"""SELECT 'table-' || CAST(doc_id AS VARCHAR) AS table_name, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS sha256
    FROM documents JOIN labels USING (doc_id) WHERE {_KIND} = 'whole'""",
)
def archive_tables(spark, sf):
    index = table(spark, sf, "labels").select(F.concat(F.lit("table-"), F.col("doc_id").cast("string")).alias("table_name"))
    # A zero-sized member is no table.
    members = A.table_members(A.expand_archives(landed_archives(spark, sf)), index).filter("size > 0")
    misnamed = F.col("member").endswith("..csv")
    return members.filter(~misnamed).select("table_name", "size", F.sha2("content", 256).alias("sha256"))


@query(
    "archive_member_lines",
    f"""SELECT CAST(doc_id AS VARCHAR) AS archive, CAST(count(*) AS BIGINT) AS n_lines FROM (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE {_KIND} = 'whole') WHERE line <> '' GROUP BY 1""",
)
def archive_member_lines(spark, sf):
    members = A.expand_archives(landed_archives(spark, sf)).filter(
        F.col("member").rlike(r"^table-\d+\.csv$") & (F.col("size") > 0)
    )
    return A.member_lines(members).groupBy("archive").agg(F.count("*").alias("n_lines"))


#: Cells per row of the customer grid.
GRID = 40


def customer_grid(spark, sf):
    """One unit square per customer, side by side; nations form patches of squares."""
    x, y = F.col("c_custkey") % GRID, F.floor(F.col("c_custkey") / GRID)
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    ring = F.array(*[F.array((x + i).cast("double"), (y + j).cast("double")) for i, j in corners])
    # the table is a few small files, its squares are many times as large
    spread = table(spark, sf, "customer").repartition(spark.sparkContext.defaultParallelism)
    return spread.select(
        "c_custkey", F.col("c_nationkey").cast("bigint").alias("nation"), "c_mktsegment", F.array(F.array(ring)).alias("parts")
    )


@query(
    "boundary_scan",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS "GEO_ID", c_mktsegment AS eng, 1.0::DOUBLE AS area, (c_custkey % {GRID})::DOUBLE AS min_x,
      (c_custkey // {GRID})::DOUBLE AS min_y FROM customer""",
)
def boundary_scan(spark, sf):
    lines = customer_grid(spark, sf).select(
        geojson_feature(
            F.col("parts"), {"GEO_ID": F.col("c_custkey").cast("string"), "eng": F.col("c_mktsegment")}
        ).alias("value")
    )
    path = scratch_path(spark, "geojsonseq")
    lines.write.text(path)
    layer = B.with_properties(B.read_feature_lines(spark, path), ["GEO_ID", "eng"])
    return outline_measures(ring_edges(layer, ["GEO_ID", "eng"]), ["GEO_ID", "eng"]).select(
        "GEO_ID", "eng", "area", "min_x", "min_y"
    )


_NEIGHBOURS = f"""cells AS (SELECT c_custkey AS k, c_custkey % {GRID} AS x, c_custkey // {GRID} AS y, c_nationkey AS nation FROM customer),
  walls AS (SELECT c.nation AS nation, count(*) AS n FROM cells c
    CROSS JOIN (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(dx, dy)
    LEFT JOIN cells o ON o.x = c.x + dx AND o.y = c.y + dy AND o.nation = c.nation WHERE o.k IS NULL GROUP BY 1),
  sizes AS (SELECT nation, count(*) AS n FROM cells GROUP BY 1)"""


@query(
    "dissolve_area",
    f"""WITH {_NEIGHBOURS} SELECT CAST(nation AS BIGINT) AS nation, sizes.n::DOUBLE AS area, CAST(walls.n AS BIGINT) AS n_edges
    FROM sizes JOIN walls USING (nation)""",
)
def dissolve_area(spark, sf):
    outline = dissolve_edges(ring_edges(customer_grid(spark, sf), ["nation"]), ["nation"])
    return outline_measures(outline, ["nation"]).select("nation", "area", "n_edges")


_COVERED = f"""cells AS (SELECT DISTINCT c_nationkey AS nation, c_custkey % {GRID} + i AS x, c_custkey // {GRID} AS y
    FROM customer CROSS JOIN (VALUES (0), (1)) o(i)),
  walls AS (SELECT c.nation AS nation, count(*) AS n FROM cells c
    CROSS JOIN (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(dx, dy)
    LEFT JOIN cells o ON o.x = c.x + dx AND o.y = c.y + dy AND o.nation = c.nation WHERE o.nation IS NULL GROUP BY 1),
  sizes AS (SELECT nation, count(*) AS n FROM cells GROUP BY 1)"""


@query(
    "dissolve_overlaps",
    f"""WITH {_COVERED} SELECT CAST(nation AS BIGINT) AS nation, sizes.n::DOUBLE AS area, walls.n::DOUBLE AS perimeter
    FROM sizes JOIN walls USING (nation)""",
)
def dissolve_overlaps(spark, sf):
    """Areas two cells wide: neighbours overlap and have vertices in the middle of each other's edges."""
    wide = customer_grid(spark, sf).withColumn(
        "parts",
        F.transform("parts", lambda part: F.transform(part, lambda ring: F.transform(ring, lambda q: F.array(
            F.when(q[0] > F.col("c_custkey") % GRID, q[0] + 1).otherwise(q[0]), q[1]
        )))),
    )
    outline = dissolve_edges(ring_edges(wide, ["nation"]), ["nation"])
    length = F.abs(F.col("bx") - F.col("ax")) + F.abs(F.col("by") - F.col("ay"))
    around = outline.groupBy("nation").agg(F.sum(length).alias("perimeter"))
    return outline_measures(outline, ["nation"]).select("nation", "area").join(around, "nation")


@query(
    "dissolve_rings",
    f"""WITH {_NEIGHBOURS} SELECT CAST(nation AS BIGINT) AS nation, sizes.n::DOUBLE AS area, CAST(walls.n AS BIGINT) AS n_points
    FROM sizes JOIN walls USING (nation)""",
)
def dissolve_rings(spark, sf):
    outline = dissolve_edges(ring_edges(customer_grid(spark, sf), ["nation"]), ["nation"])
    rings = ring_table(build_rings(outline, ["nation"]), ["nation"])
    placed = assign_holes(rings, ["nation"])
    return placed.groupBy("nation").agg(
        F.sum("area").alias("area"), F.sum(F.size("coordinates") - 1).alias("n_points")
    )


@query(
    "dissolve_attributes",
    f"""WITH {_NEIGHBOURS} SELECT CAST(nation AS BIGINT) AS nation, seg AS c_mktsegment, s.n::DOUBLE AS area FROM
      (SELECT nation, n FROM sizes) s JOIN (SELECT c_nationkey AS nation, arg_min(c_mktsegment, c_custkey) AS seg FROM customer GROUP BY 1) USING (nation)""",
)
def dissolve_attributes(spark, sf):
    shapes = dissolve(customer_grid(spark, sf), "nation", ["c_mktsegment"], "c_custkey")
    area = outline_measures(ring_edges(shapes, ["nation"]), ["nation"]).select("nation", "area")
    return shapes.drop("parts").join(area, "nation")


@query(
    "boundary_wkb",
    "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(9 + 9 + 4 + 5 * 16 AS BIGINT) AS n_bytes, '0106000000' AS head FROM customer",
)
def boundary_wkb(spark, sf):
    encoded = customer_grid(spark, sf).select("c_custkey", to_wkb("parts").alias("wkb"))
    return encoded.select(
        "c_custkey", F.octet_length("wkb").cast("bigint").alias("n_bytes"), F.lower(F.substring(F.hex("wkb"), 1, 10)).alias("head")
    )


@query(
    "layer_check",
    "SELECT p_type AS layer, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1",
)
def layer_check(spark, sf):
    layers = table(spark, sf, "part").groupBy(F.col("p_type").alias("layer")).agg(F.count("*").alias("n"))
    B.require_layers(layers, ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
    return layers


def catalogue_triples(spark, sf):
    """Documents as a catalogue: one dataset per source with a title per document and language."""
    subject = F.concat(F.lit("<http://example.com/"), "source", F.lit(">"))
    escaped = F.col("text")
    for plain, code in (
        ("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("é", "\\u00E9"), ("ü", "\\U000000fc"), ("'", "\\'"),
    ):
        escaped = F.replace(escaped, F.lit(plain), F.lit(code))
    title = F.concat(subject, F.lit(f' <{R.TITLE}> "'), escaped, F.lit('"@'), "lang", F.lit(' . # "note" .'))
    return R.parse_triple_lines(
        table(spark, sf, "documents").select(title.alias("value"))
    )


@query(
    "triple_objects",
    """SELECT DISTINCT 'http://example.com/' || source AS s, text AS o, lang AS lang, CAST(NULL AS VARCHAR) AS datatype FROM documents""",
)
def triple_objects(spark, sf):
    return R.objects(catalogue_triples(spark, sf), R.TITLE)


@query(
    "text_by_language",
    """SELECT 'http://example.com/' || source AS s, arg_min(text, struct_pack(r := CASE lang WHEN 'nl' THEN 1 WHEN 'en' THEN 2 WHEN 'fr' THEN 3 WHEN 'de' THEN 4 END, t := text)) AS text
    FROM documents WHERE lang IN ('nl', 'en', 'fr', 'de') GROUP BY 1""",
)
def text_by_language(spark, sf):
    return R.text_by_language(catalogue_triples(spark, sf), R.TITLE, "nl")


@query(
    "preferred_format",
    """WITH f AS (SELECT o_custkey AS c, o_orderkey AS k, CASE o_orderpriority WHEN '1-URGENT' THEN 'XLSX' WHEN '2-HIGH' THEN 'TXT' WHEN '3-MEDIUM' THEN 'GEOJSON'
        WHEN '4-NOT SPECIFIED' THEN 'CSV' ELSE 'UNKNOWN' END AS fmt, CASE o_orderpriority WHEN '1-URGENT' THEN 8 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 5 END AS r FROM orders),
    w AS (SELECT c, arg_min(struct_pack(k := k, fmt := fmt), struct_pack(r := r, u := 'http://example.com/f/' || CAST(k AS VARCHAR) || '.zip')) AS p FROM f WHERE r IS NOT NULL GROUP BY 1)
    SELECT 'http://example.com/c' || CAST(c AS VARCHAR) AS s, 'http://example.com/f/' || CAST(p.k AS VARCHAR) || '.zip' AS url, p.fmt AS format,
      CAST(p.k AS VARCHAR) || CASE p.fmt WHEN 'XLSX' THEN '.xlsx' WHEN 'TXT' THEN '.txt' WHEN 'CSV' THEN '.csv' ELSE '' END AS member FROM w
    UNION ALL SELECT 'http://example.com/c' || CAST(o_custkey AS VARCHAR), NULL, NULL, NULL FROM orders GROUP BY o_custkey
      HAVING bool_and(o_orderpriority = '5-LOW')""",
)
def preferred_format(spark, sf):
    orders = table(spark, sf, "orders")
    url = F.concat(F.lit("http://example.com/f/"), F.col("o_orderkey").cast("string"), F.lit(".zip"))
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "XLSX").when(F.col("o_orderpriority") == "2-HIGH", "TXT")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "GEOJSON").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "CSV").otherwise("UNKNOWN")
    )
    node = F.concat(F.lit("http://example.com/c"), F.col("o_custkey").cast("string"))
    none = F.lit(None).cast("string")
    triples = orders.select(F.explode(F.array(
        F.struct(node.alias("s"), F.lit(R.DISTRIBUTION).alias("p"), url.alias("o")),
        F.struct(url.alias("s"), F.lit(R.FORMAT).alias("p"), F.concat(F.lit(D.FORMAT_ROOT), name).alias("o")),
    )).alias("t")).select("t.*", none.alias("lang"), none.alias("datatype"))
    return R.distributions(triples).select("s", "url", "format", "member")


@query(
    "landing_page_by_language",
    """SELECT 'http://example.com/' || source AS s, 'http://example.com/page/' || arg_min(CAST(doc_id AS VARCHAR), struct_pack(
      r := CASE lang WHEN 'fr' THEN 1 WHEN 'en' THEN 2 WHEN 'de' THEN 3 WHEN 'nl' THEN 4 END, p := 'http://example.com/page/' || CAST(doc_id AS VARCHAR))) AS page
    FROM documents WHERE lang IN ('en', 'fr', 'de', 'nl') GROUP BY source""",
)
def landing_page_by_language(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source", "lang")
    node = F.concat(F.lit("http://example.com/"), "source")
    page = F.concat(F.lit("http://example.com/page/"), F.col("doc_id").cast("string"))
    language = F.concat(F.lit("http://example.com/language/"), "lang")
    none = F.lit(None).cast("string")
    triples = documents.select(F.explode(F.array(
        F.struct(node.alias("s"), F.lit(R.LANDING_PAGE).alias("p"), page.alias("o")),
        F.struct(page.alias("s"), F.lit(R.LANGUAGE).alias("p"), language.alias("o")),
    )).alias("t")).select("t.*", none.alias("lang"), none.alias("datatype"))
    codes = documents.select("lang").distinct().select(
        language.alias("s"), F.lit(R.NOTATION).alias("p"), F.col("lang").alias("o"), none.alias("lang"), F.lit(R.ISO_639_1).alias("datatype"))
    return R.landing_pages(triples, codes, "fr")


_LINKS = r"""links AS (SELECT url, unnest(range(len(h))) AS pos, unnest(h) AS href FROM (
  SELECT url, regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1) AS h FROM pages))"""


@query("page_links", f"WITH {_LINKS} SELECT url, CAST(pos AS BIGINT) AS pos, href FROM links")
def page_links(spark, sf):
    return P.links(table(spark, sf, "pages")).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "page_link_first",
    f"""WITH {_LINKS} SELECT url, arg_min(href, pos) FILTER (WHERE starts_with(href, '/')) AS table_url,
      arg_min(href, pos) FILTER (WHERE contains(href, 'e')) AS metadata_url FROM links GROUP BY 1""",
)
def page_link_first(spark, sf):
    href = F.col("href")
    return P.first_link(
        P.links(table(spark, sf, "pages")), {"table_url": href.startswith("/"), "metadata_url": href.contains("e")}
    )


@query(
    "index_page_files",
    rf"""WITH {_LINKS}, n AS (SELECT url, regexp_extract(href, '([^/]*)$', 1) AS name FROM links)
    SELECT url, name FROM n WHERE starts_with(name, 'th')""",
)
def index_page_files(spark, sf):
    return P.index_files(table(spark, sf, "pages"), "th").select("url", "name")


@query(
    "html_table_rows",
    """SELECT CAST(p_partkey AS VARCHAR) AS url, p_brand AS table_id, p_name AS description, p_type || '.zip' AS filename, '/output/' || p_type AS href FROM part""",
)
def html_table_rows(spark, sf):
    part = table(spark, sf, "part")
    html = F.concat(
        F.lit("<html><body><p>x</p><table><tr><th>id</th><th>about</th><th>file</th></tr>"),
        F.lit("<tr><td colspan='3'>Sub-heading &amp; more</td></tr><tr><td> "), "p_brand", F.lit("</td><td><b>"), "p_name",
        F.lit("</b></td><td><a href='/output/"), "p_type", F.lit("'>"), "p_type", F.lit(".zip</a></td></tr></table></body></html>"),
    )
    pages = part.select(F.col("p_partkey").cast("string").alias("url"), html.alias("html"))
    cells = P.named_cells(P.table_rows(pages), ["table_id", "description", "release"])
    return cells.select(
        "url", "table_id.text", F.col("description.text").alias("about"), F.col("release.text").alias("filename"), F.col("release.href").alias("href")
    ).withColumnsRenamed({"text": "table_id", "about": "description"})


@query(
    "page_section_text",
    "SELECT CAST(p_partkey AS VARCHAR) AS url, p_name || chr(10) || p_type || chr(10) || 'end' AS text FROM part",
)
def page_section_text(spark, sf):
    html = F.concat(
        F.lit('<html><div class="a">no</div><div class="b" id="landing">\n <div><h1>'), "p_name", F.lit("</h1></div><br> <p>"), "p_type", F.lit("</p>\nend</div>no</html>")
    )
    pages = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("url"), html.alias("html"))
    return P.section_text(pages, "landing")


@query(
    "nested_json_rows",
    """SELECT upper(p_name) AS subzone, s AS gender, CAST(lo AS BIGINT) AS age_min, CAST(hi AS BIGINT) AS age_max,
      CAST(CASE WHEN lo = 90 THEN 0 ELSE p_size * 1000 END AS BIGINT) AS population, CAST(count(*) AS BIGINT) AS n
    FROM part, (VALUES ('Males'), ('Females')) g(s), (VALUES (0, NULL), (0, 4), (90, NULL)) a(lo, hi) GROUP BY ALL""",
)
def nested_json_rows(spark, sf):
    number = F.format_number(F.col("p_size") * 1000, 0)
    bands = F.array(
        F.struct(F.lit("Total").alias("key"), number.alias("value")),
        F.struct(F.lit("0 - 4").alias("key"), number.alias("value")),
        F.struct(F.lit("90 & Over").alias("key"), F.lit("-").alias("value")),
    )
    groups = F.array(*[F.struct(F.lit(s).alias("key"), bands.alias("columns")) for s in ("Males", "Females")])
    rows = F.array(
        F.struct(F.lit("1").alias("rowNo"), F.lit("Region").alias("rowText"), groups.alias("columns")),
        F.struct(F.lit("1.2").alias("rowNo"), F.col("p_name").alias("rowText"), groups.alias("columns")),
    )
    documents = table(spark, sf, "part").select(
        F.to_json(F.struct(F.struct(rows.alias("row")).alias("Data"))).alias("value")
    )
    people = N.subzone_population(documents)
    return people.groupBy(
        "subzone", "gender", F.col("age_min").cast("bigint").alias("age_min"), F.col("age_max").cast("bigint").alias("age_max"), "population"
    ).agg(F.count("*").alias("n"))


@query(
    "event_properties",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def event_properties(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k")
    )


@query(
    "level_catalogue",
    """SELECT url AS node, 'T' || CAST(page_id AS VARCHAR) AS table_id, level AS geo_level, level || '/T' || CAST(page_id AS VARCHAR) AS partition_key,
      'T' || CAST(page_id AS VARCHAR) || ': ' || url AS human_readable_name, 'About ' || url AS description,
      'https://x.org/t?v=' || level || '&c=' || CAST(page_id AS VARCHAR) AS source_download_url, url AS source_documentation_url,
      '{"columns":[' || CAST(page_id AS VARCHAR) || ']}' AS table_schema
    FROM pages, (VALUES ('DZ21'), ('SDZ21'), ('LGD14')) l(level)""",
)
def level_catalogue(spark, sf):
    number = F.col("page_id").cast("string")
    document = F.to_json(F.struct(
        F.concat(F.lit("T"), number, F.lit(": "), "url").alias("dc:title"),
        F.concat(F.lit("About "), "url").alias("dc:description"),
        F.concat(F.lit("https://x.org/t?v=DZ21&c="), number).alias("url"),
        F.struct(F.array("page_id").alias("columns")).alias("tableSchema"),
    ))
    documents = table(spark, sf, "pages").select("url", document.alias("value"))
    return N.level_catalogue(documents, ["DZ21", "SDZ21", "LGD14"])


@query(
    "described_attributes",
    "SELECT c_custkey, upper(c_name) AS SUBZONE_N, c_mktsegment AS PLN_AREA_N FROM customer",
)
def described_attributes(spark, sf):
    html = F.concat(
        F.lit("<center><table><tr><th>SUBZONE_N</th> <td>"), F.upper("c_name"), F.lit("</td></tr><tr><th>PLN_AREA_N</th><td>"), "c_mktsegment", F.lit("</td></tr></table></center>")
    )
    found = B.described_attributes(html, ["SUBZONE_N", "PLN_AREA_N"])
    return table(spark, sf, "customer").select("c_custkey", *[c.alias(n) for n, c in found.items()])


@query(
    "widen_parquets",
    """SELECT CAST(o_custkey AS VARCHAR) AS "GEO_ID",
      CAST(sum(floor(o_totalprice)) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS "B01_E001",
      CAST(sum(floor(o_totalprice)) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS "B02_E001",
      CAST(sum(floor(o_totalprice)) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS "B03_E001" FROM orders GROUP BY 1""",
)
def widen_parquets(spark, sf):
    base = scratch_path(spark, "widen")
    orders = table(spark, sf, "orders")
    paths = []
    for i, status in enumerate("FOP", start=1):
        path = f"{base}/b0{i}.parquet"
        orders.filter(F.col("o_orderstatus") == status).groupBy(F.col("o_custkey").cast("string").alias("GEO_ID")).agg(
            F.sum(F.floor("o_totalprice")).alias(f"B0{i}_E001"), F.max("o_totalprice").alias(f"B0{i}_M001")
        ).write.parquet(path)
        paths.append(path)
    return D.widen_parquets(spark, paths)


@query(
    "dataset_by_slug",
    "SELECT DISTINCT p_name AS description, replace(p_name, ' ', '_') AS name FROM part WHERE p_name = 'small ring'",
)
def dataset_by_slug(spark, sf):
    datasets = table(spark, sf, "part").select(F.col("p_name").alias("description")).distinct()
    return L.dataset_by_name(datasets, "small_ring")


@query(
    "landed_integrity",
    """SELECT CAST(d.doc_id AS VARCHAR) AS path, CASE WHEN d.lang = 'de' THEN 'missing' WHEN d.lang = 'fr' THEN 'corrupt'
      WHEN l.toxic = 1 THEN 'wrong size' WHEN l.quality = 0 THEN 'stale' ELSE 'ok' END AS status
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def landed_integrity(spark, sf):
    documents = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    content = F.encode("text", "UTF-8")
    day = F.lit("2024-01-01").cast("timestamp")
    files = documents.filter("lang <> 'de'").select(
        F.col("doc_id").cast("string").alias("path"), F.octet_length(content).cast("bigint").alias("size"),
        day.alias("modified"), F.sha2(content, 256).alias("sha256"))
    manifest = documents.join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("path"),
        F.when(F.col("lang") == "fr", F.sha2(F.lit(""), 256)).otherwise(F.sha2(content, 256)).alias("expected_sha256"),
        (F.octet_length(content) + F.col("toxic")).cast("bigint").alias("expected_size"),
        F.when(F.col("quality") == 0, 5).otherwise(90).alias("refresh_days"))
    return L.integrity(files, manifest, F.lit("2024-02-01").cast("timestamp")).select("path", "status")


@query(
    "format_dispatch",
    "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def format_dispatch(spark, sf):
    base = scratch_path(spark, "formats")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    supplier.write.option("sep", "|").option("header", True).csv(f"{base}/txt")
    supplier.write.json(f"{base}/geojson")
    readers = {
        "TXT": lambda: D.read_delimited(spark, f"{base}/txt", supplier.schema, DelimitedFormat("|", quoted=False)),
        "GEOJSON": lambda: spark.read.schema(supplier.schema).json(f"{base}/geojson"),
    }
    return D.scan_by_format(D.FORMAT_ROOT + "TXT", readers).unionByName(D.scan_by_format("GEOJSON", readers))
