"""Order-dependent operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions.text import description_to_names
from arealis.operators import grouping as G
from arealis.operators import ordered as O
from workbench.base import query, table
#: Turns per chunk.  A conversation of any length is carried along in pieces.
CHUNK = 100_000


def _turns(spark, sf):
    """Turns with whole texts; user and system turns act as headings."""
    t = table(spark, sf, "conversations")
    return t.select("conv_id", "turn", "role", "text")


@query(
    "forward_fill",
    """SELECT conv_id, turn, last_value(CASE WHEN role <> 'assistant' THEN text END IGNORE NULLS) OVER w AS title,
      last_value(CASE WHEN role = 'system' THEN text END IGNORE NULLS) OVER w AS universe
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text ROWS UNBOUNDED PRECEDING)""",
)
def forward_fill(spark, sf):
    turns = _turns(spark, sf)
    filled = O.carry_forward(
        turns,
        ["conv_id"],
        F.expr(f"turn div {CHUNK}"),
        [F.col("turn"), F.col("text")],
        {
            "title": F.when(F.col("role") != "assistant", F.col("text")),
            "universe": F.when(F.col("role") == "system", F.col("text")),
        },
    )
    return filled.select("conv_id", "turn", "title", "universe")


@query(
    "stub_paths",
    """WITH t AS (SELECT conv_id, turn, role, CASE WHEN role <> 'assistant' THEN replace(text, ':', '') END AS edge,
        replace(text, ':', '') AS shown,
        min(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS leaf FROM conversations),
    e AS (SELECT *, list(edge) FILTER (WHERE edge IS NOT NULL AND (leaf IS NULL OR turn < leaf))
            OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS base,
          last_value(CASE WHEN leaf IS NOT NULL AND turn >= leaf THEN edge END IGNORE NULLS)
            OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS latest FROM t),
    p AS (SELECT conv_id, turn, role, shown,
      CASE WHEN latest IS NULL THEN coalesce(base, []) ELSE list_concat(coalesce(base[1:len(base) - 1], []), [latest]) END AS path FROM e)
    SELECT conv_id, turn, array_to_string(path, '|') || CASE WHEN role = 'assistant' THEN '|' || shown ELSE '' END AS variable_extended_name
    FROM p""",
)
def stub_paths(spark, sf):
    turns = _turns(spark, sf)
    plain = F.replace("text", F.lit(":"), F.lit(""))
    stubs = turns.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", plain).otherwise(F.concat(plain, F.lit(":"))).alias("stub"),
    )
    return O.stub_paths(stubs, ["conv_id"], F.expr(f"turn div {CHUNK}"), F.col("turn"), "stub").select(
        "conv_id", "turn", "variable_extended_name"
    )


@query(
    "preferred_language",
    """SELECT source, arg_min(text, struct_pack(r := CASE lang WHEN 'nl' THEN 1 WHEN 'en' THEN 2 WHEN 'fr' THEN 3 WHEN 'de' THEN 4 END, d := doc_id)) AS text
    FROM documents WHERE lang IN ('nl', 'en', 'fr', 'de') GROUP BY 1""",
)
def preferred_language(spark, sf):
    from arealis.sources.triples import ranked_languages

    return table(spark, sf, "documents").groupBy("source").agg(
        O.preferred(F.col("text"), F.col("lang"), ranked_languages("nl"), F.col("doc_id")).alias("text")
    )


@query(
    "latest_record",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_record(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return O.latest_record(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "first_record",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def first_record(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return O.first_record(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "preview_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5",
)
def preview_rows(spark, sf):
    return O.preview(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query(
    "drop_last_rows",
    """SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER
      (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn > 2""",
)
def drop_last_rows(spark, sf):
    return O.drop_last_rows(table(spark, sf, "events").select("user_id", "event_id"), ["user_id"], "event_id", 2)


@query(
    "positional_zip",
    """SELECT p_partkey, p_brand AS "Age", p_type AS "Sex" FROM part""",
)
def positional_zip(spark, sf):
    names = description_to_names(F.lit("Residence by sex by age"), {"Residence by sex by age": ["Age", "Sex"]})
    keyed = table(spark, sf, "part").select(
        "p_partkey", O.zip_to_map(names, F.concat_ws("__", "p_brand", "p_type"), "__").alias("m")
    )
    return keyed.select("p_partkey", F.col("m")["Age"].alias("Age"), F.col("m")["Sex"].alias("Sex"))


@query(
    "description_names",
    """SELECT p_partkey, array_to_string(list_transform(list_reverse(string_split(p_type || ' by ' || p_name, ' by ')),
       lambda x: replace(array_to_string(list_transform(string_split(x, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' '), ' ', '')), ';') AS names
    FROM part""",
)
def description_names(spark, sf):
    text = F.concat("p_type", F.lit(" by "), "p_name")
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(description_to_names(text, {}), ";").alias("names")
    )


@query(
    "dense_row_number",
    """SELECT p_type, p_partkey, CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_name, p_partkey) AS BIGINT) AS row_number
    FROM part""",
)
def dense_row_number(spark, sf):
    part = table(spark, sf, "part").select("p_type", "p_name", "p_partkey")
    return O.dense_row_number(part, ["p_type"], ["p_name", "p_partkey"]).drop("p_name")


@query(
    "batch_tables",
    """SELECT p_brand, CAST(batch AS BIGINT) AS batch, string_agg(p_name, ',' ORDER BY rn) AS items FROM (
      SELECT p_brand, p_name, rn, (rn - 1) // 10 AS batch FROM (
        SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part)) GROUP BY 1, 2""",
)
def batch_tables(spark, sf):
    batched = G.batches(table(spark, sf, "part"), ["p_brand"], "p_name", ["p_partkey"], 10)
    return batched.select("p_brand", F.col("batch").cast("bigint").alias("batch"), F.array_join("items", ",").alias("items"))


@query(
    "first_and_concat",
    """WITH idx AS (SELECT source, lang, min(doc_id) AS idx FROM documents GROUP BY 1, 2)
    SELECT source, arg_min(lang, idx) AS first_lang, string_agg(lang, ', ' ORDER BY idx) AS variables FROM idx GROUP BY 1""",
)
def first_and_concat(spark, sf):
    index = table(spark, sf, "documents").groupBy("source", "lang").agg(F.min("doc_id").alias("idx"))
    return index.groupBy("source").agg(
        G.first_by(F.col("lang"), F.col("idx")).alias("first_lang"),
        G.ordered_concat(F.col("lang"), F.col("idx")).alias("variables"),
    )
