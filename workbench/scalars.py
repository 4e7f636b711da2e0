"""Column functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import codes, ids, text, urls
from arealis.operators.metadata import publish_names
from workbench.base import query, table


@query(
    "text_functions",
    """SELECT p_partkey, lower(p_name) AS low, upper(p_name) AS up, trim(p_name) AS stripped,
      replace(p_brand, 'Brand#', '') AS replaced, string_split(p_name, ' ')[1] AS first_word,
      string_split(p_name, ' ')[-1] AS last_word, p_brand || '/' || p_type AS joined,
      CASE WHEN starts_with(p_brand, 'Brand#') THEN substr(p_brand, 7) ELSE p_brand END AS no_prefix FROM part""",
)
def text_functions(spark, sf):
    name, brand = F.col("p_name"), F.col("p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.lower(name).alias("low"),
        F.upper(name).alias("up"),
        F.trim(name).alias("stripped"),
        F.replace(brand, F.lit("Brand#"), F.lit("")).alias("replaced"),
        F.split(name, " ")[0].alias("first_word"),
        text.last_part(name, " ").alias("last_word"),
        F.concat_ws("/", brand, "p_type").alias("joined"),
        text.remove_prefix(brand, "Brand#").alias("no_prefix"),
    )


@query(
    "title_case",
    r"""SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '(\p{L}+|[^\p{L}]+)', 1),
      lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(w[2:])), '') AS titled FROM documents""",
)
def title_case(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.title_case(F.col("text")).alias("titled"))


@query(
    "keep_alphanumeric",
    r"SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}]', '', 'g') AS kept FROM documents",
)
def keep_alphanumeric(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.keep_alphanumeric(F.col("text")).alias("kept"))


@query(
    "slug",
    """SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM pages""",
)
def slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query(
    "named_groups",
    r"""SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)', 1) AS scheme,
      regexp_extract(url, '^(https?)://([^/]+)', 2) AS host, regexp_extract(url, '[?&]page=(\d+)', 1) AS page FROM pages""",
)
def named_groups(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract(url, r"^(https?)://([^/]+)", 1).alias("scheme"),
        F.regexp_extract(url, r"^(https?)://([^/]+)", 2).alias("host"),
        F.regexp_extract(url, r"[?&]page=(\d+)", 1).alias("page"),
    )


@query(
    "count_text_parse",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE floor(o_totalprice) END AS BIGINT) AS n FROM orders""",
)
def count_text_parse(spark, sf):
    shown = (
        F.when(F.col("o_orderstatus") == "P", F.lit("-"))
        .otherwise(F.format_number(F.floor("o_totalprice"), 0))
    )
    return table(spark, sf, "orders").select("o_orderkey", codes.count_from_text(shown).alias("n"))


@query(
    "age_band",
    """SELECT p_partkey, CAST(CASE WHEN p_size > 45 THEN 0 WHEN p_size > 40 THEN 90 ELSE p_size END AS BIGINT) AS age_min,
      CAST(CASE WHEN p_size > 40 THEN NULL ELSE p_size + 4 END AS BIGINT) AS age_max FROM part""",
)
def age_band(spark, sf):
    size = F.col("p_size")
    shown = (
        F.when(size > 45, "Total")
        .when(size > 40, "90 & Over")
        .otherwise(F.concat(size.cast("string"), F.lit(" - "), (size + 4).cast("string")))
    )
    band = codes.age_band(shown)
    return table(spark, sf, "part").select(
        "p_partkey", band["age_min"].cast("bigint").alias("age_min"), band["age_max"].cast("bigint").alias("age_max")
    )


@query(
    "code_label",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'single' WHEN 'O' THEN 'married' ELSE 'widowed' END AS label,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Belgian' END AS maybe FROM orders""",
)
def code_label(spark, sf):
    number = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    nation = F.when(F.col("o_orderpriority") == "1-URGENT", "BEL").otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        codes.code_label(number, codes.MARITAL_STATUS).alias("label"),
        codes.code_label(nation, {"BEL": "Belgian"}, strict=False).alias("maybe"),
    )


@query(
    "metric_column_names",
    """SELECT p_partkey, p_brand || '_' || p_type || '_' || CAST(p_size AS VARCHAR) AS single,
      p_brand || '__' || p_type AS double FROM part""",
)
def metric_column_names(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        text.join_key(F.col("p_brand"), F.col("p_type"), F.col("p_size")).alias("single"),
        text.join_key(F.col("p_brand"), F.col("p_type"), separator="__").alias("double"),
    )


@query(
    "hxl_tags",
    """SELECT p_partkey, '#population+PartBrand_' || replace(p_brand, '#', '') || '+PartType_' || p_type AS tag,
      'Variable: ''Part Brand''; Value: ''' || p_brand || '''; Variable: ''Part Type''; Value: ''' || p_type || '''' AS name,
      '#population+Name_' || replace(p_name, ' ', '') AS array_tag, 'Variable: ''Name''; Value: ''' || p_name || '''' AS array_name
    FROM part""",
)
def hxl_tags(spark, sf):
    names, values = ["Part Brand", "Part Type"], [F.col("p_brand"), F.col("p_type")]
    keys, found = F.array(F.lit("Name")), F.array("p_name")
    return table(spark, sf, "part").select(
        "p_partkey",
        text.hxl_population_tag(names, values).alias("tag"),
        text.human_name(names, values).alias("name"),
        text.hxl_population_tag_from_arrays(keys, found).alias("array_tag"),
        text.human_name_from_arrays(keys, found).alias("array_name"),
    )


@query(
    "universe_hxl",
    """SELECT p_partkey, '#' || p_type_t || '+' || array_to_string(list_transform(string_split(p_name, ' '),
       lambda w: upper(w[1]) || lower(w[2:])), '+') AS tag FROM (
       SELECT *, upper(p_type[1]) || lower(p_type[2:]) AS p_type_t FROM part)""",
)
def universe_hxl(spark, sf):
    path = F.replace("p_name", F.lit(" "), F.lit("|"))
    return table(spark, sf, "part").select("p_partkey", text.hxl_universe_tag(F.col("p_type"), path).alias("tag"))


@query(
    "templated_names",
    """SELECT o_orderkey, '#population+adm4+' || lower(o_orderstatus) || '+age' || CAST(year(o_orderdate) AS VARCHAR) AS tag,
      'Population, ' || o_orderpriority || ', and age ' || CAST(year(o_orderdate) AS VARCHAR) AS name FROM orders""",
)
def templated_names(spark, sf):
    tag = "concat('#population+adm4+', lower(o_orderstatus), '+age', year(o_orderdate))"
    name = "format_string('Population, %s, and age %d', o_orderpriority, year(o_orderdate))"
    return table(spark, sf, "orders").select("o_orderkey", F.expr(tag).alias("tag"), F.expr(name).alias("name"))


@query(
    "variable_codes",
    """SELECT p_partkey, 'B' || lpad(CAST(p_size AS VARCHAR), 5, '0') || '_' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS variable,
      'B' || lpad(CAST(p_size AS VARCHAR), 5, '0') || '_M' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS margin FROM part""",
)
def variable_codes(spark, sf):
    size = F.col("p_size").cast("string")
    column = F.concat(F.lit("B"), F.lpad(size, 5, "0"), F.lit("_E"), F.lpad(size, 3, "0"))
    variable = codes.column_to_variable(column)
    return table(spark, sf, "part").select(
        "p_partkey", variable.alias("variable"), codes.variable_to_column(variable).alias("margin")
    )


@query(
    "url_parts",
    r"""WITH u AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
    SELECT page_id, path, regexp_extract(path, '([^/]*)/?$', 1) AS last,
      regexp_replace(regexp_extract(path, '([^/]*)/?$', 1), '^(.+)\.[^.]*$', '\1') || '.txt' AS swapped,
      'https://example.com/' || CAST(page_id AS VARCHAR) || '.zip' AS rooted,
      'https://example.com/a/' || CAST(page_id AS VARCHAR) || '.zip' AS relative, url AS absolute,
      'https://x.org/t?d=PEOPLE&v=LGD14&c=' || CAST(page_id AS VARCHAR) AS level_url FROM u""",
)
def url_parts(spark, sf):
    path = urls.url_path(F.col("url"))
    number = F.col("page_id").cast("string")
    level = F.concat(F.lit("https://x.org/t?d=PEOPLE&v=DZ21&c="), number)
    return table(spark, sf, "pages").select(
        "page_id",
        path.alias("path"),
        urls.last_segment(path).alias("last"),
        urls.swap_suffix(urls.last_segment(path), ".txt").alias("swapped"),
        urls.join_root("https://example.com/a", F.concat(F.lit("/"), number, F.lit(".zip"))).alias("rooted"),
        urls.join_root("https://example.com/a", F.concat(number, F.lit(".zip"))).alias("relative"),
        urls.join_root("https://example.com/a", F.col("url")).alias("absolute"),
        urls.with_level_parameter(level, F.lit("LGD14")).alias("level_url"),
    )


@query(
    "url_quote",
    "SELECT doc_id, replace(replace(replace(url_encode(text), '+', '%2B'), '%2F', '/'), ' ', '%20') AS quoted FROM documents",
)
def url_quote(spark, sf):
    return table(spark, sf, "documents").select("doc_id", urls.quote(F.col("text")).alias("quoted"))


@query(
    "state_codes",
    """SELECT c_custkey, CASE WHEN n BETWEEN 1 AND 55 AND n NOT IN (3, 7, 14, 43, 52) THEN lpad(CAST(n AS VARCHAR), 2, '0') END AS fips,
      n BETWEEN 1 AND 55 AND n NOT IN (3, 7, 14, 43, 52) AS listed FROM (SELECT c_custkey, c_custkey % 60 AS n FROM customer)""",
)
def state_codes(spark, sf):
    number = (F.col("c_custkey") % 60).cast("int")
    return table(spark, sf, "customer").select(
        "c_custkey",
        codes.state_code(number).alias("fips"),
        F.array_contains(codes.state_codes(), F.lpad(number.cast("string"), 2, "0")).alias("listed"),
    )


@query(
    "date_functions",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, CAST(year(o_orderdate) AS BIGINT) AS year,
      o_orderdate <= TIMESTAMP '1997-06-30' AS in_order FROM orders""",
)
def date_functions(spark, sf):
    from datetime import date

    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        codes.iso_date(day).alias("iso"),
        F.year(day).cast("bigint").alias("year"),
        codes.period_is_valid(day, codes.date_literal(date(1997, 6, 30))).alias("in_order"),
    )


@query(
    "content_ids",
    """SELECT s_suppkey, sha256('{"countries_of_interest":["n' || CAST(s_nationkey AS VARCHAR) || '"],"description":null,"name":"'
      || s_name || '","url":"https://example.com/' || CAST(s_suppkey AS VARCHAR) || '"}') AS data_publisher_id FROM supplier""",
)
def content_ids(spark, sf):
    supplier = table(spark, sf, "supplier")
    rows = supplier.select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("https://example.com/"), F.col("s_suppkey").cast("string")).alias("url"),
        F.lit(None).cast("string").alias("description"),
        F.array(F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).alias("countries_of_interest"),
    )
    named = publish_names("publisher", rows)
    return named.select(
        F.substring_index("data_publisher_url", "/", -1).cast("bigint").alias("s_suppkey"), "data_publisher_id"
    )


@query("file_hash", "SELECT doc_id, sha256(text) AS sha FROM documents")
def file_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", ids.file_hash(F.encode("text", "UTF-8")).alias("sha"))


@query(
    "path_builders",
    """SELECT n_nationkey, country, country || '/geometries/' || lower(n_name) || '_2021' AS stem,
      country || '/metrics/2021' || replace(n_name, '_', '') || '.parquet' AS path, '2021/' || n_name AS partition_key,
      n_name || '_3I' AS release_key
    FROM (SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
       CASE WHEN n_regionkey = 0 THEN 'gb_nir' ELSE 'r' || CAST(n_regionkey AS VARCHAR) END AS country FROM nation)""",
)
def path_builders(spark, sf):
    sub = F.when(F.col("n_regionkey") == 0, "GB-NIR")
    country = ids.country_id(sub, F.concat(F.lit("R"), F.col("n_regionkey").cast("string")))
    key = ids.partition_key(F.lit(2021), F.col("n_name"))
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("n_nationkey"),
        country.alias("country"),
        ids.geometry_path_stem(country, F.col("n_name"), F.lit("2021-03-21").cast("date")).alias("stem"),
        ids.metric_path(country, key).alias("path"),
        key.alias("partition_key"),
        ids.release_key(F.col("n_name"), F.lit("3I")).alias("release_key"),
    )


@query(
    "integer_arithmetic",
    """SELECT event_id, CAST(event_id + user_id AS BIGINT) AS added, CAST(event_id - user_id AS BIGINT) AS subtracted,
      CAST(event_id * user_id AS BIGINT) AS multiplied FROM events""",
)
def integer_arithmetic(spark, sf):
    a, b = F.col("event_id"), F.col("user_id")
    return table(spark, sf, "events").select(
        "event_id",
        codes.add_int64(a, b).alias("added"),
        codes.subtract_int64(a, b).alias("subtracted"),
        codes.multiply_int64(a, b).alias("multiplied"),
    )


@query(
    "collection_functions",
    """SELECT p_partkey, p_size IN (1, 2, 3, 5, 8, 13) AS member, p_type AS mapped,
      CAST(len(string_split(p_name, ' ')) AS BIGINT) AS words FROM part""",
)
def collection_functions(spark, sf):
    pairs = codes.pair_map(F.array(F.lit("brand"), F.lit("type")), F.array("p_brand", "p_type"))
    listed = F.array(*[F.lit(n) for n in (1, 2, 3, 5, 8, 13)])
    return table(spark, sf, "part").select(
        "p_partkey",
        F.array_contains(listed, F.col("p_size")).alias("member"),
        pairs["type"].alias("mapped"),
        F.size(F.split("p_name", " ")).cast("bigint").alias("words"),
    )
