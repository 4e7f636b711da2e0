"""One query per operator over the driver tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arealis.llm.common import table
from arealis.llm.exact_dedup import exact_duplicates
from arealis.llm.licenses import KNOWN, SPELLINGS, license_scan
from arealis.llm.mixing import mixed
from arealis.llm.near_dedup import near_duplicates
from arealis.llm.packing import packed
from arealis.llm.prefix_trie import conversation_trie
from arealis.llm.quality import quality_scores
from arealis.llm.secret_scan import secret_digests
from arealis.llm.suffix_dedup import repeated_bytes
from arealis.llm.token_files import token_documents
from arealis.llm.toxicity import toxicity_scores
from arealis.llm.vector_search import nearest_of_step
from arealis.llm.whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query(
    "op1_minhash_near_dedup",
    r"""WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (
      SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
        ELSE array_to_string(ws[i : i + 4], ' ') END AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w
            WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b
          ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * c >= 85 * (x.n + y.n - c)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
    SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.b) AS component_id,
           d.doc_id = min(r.b) AS kept
    FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op3_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
              doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op4_token_files")
def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_documents(table(spark, sf_dir, "documents"))


@query("op8_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query(
    "op9_mixing",
    r"""WITH RECURSIVE d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '?')) AS draw FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    o AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]
                 AS w FROM s),
    whole AS (SELECT 1.5 * sum(source_size) AS budget FROM o),
    -- clamp every source above the level, then level again
    lv AS (SELECT 0 AS round, 0.0::DOUBLE AS level,
                  (SELECT budget FROM whole)::DOUBLE / (SELECT sum(w) FROM o) AS next
      UNION ALL
      SELECT round + 1, next,
        ((SELECT budget FROM whole)::DOUBLE - (SELECT coalesce(sum(2 * source_size), 0) FROM o
                                       WHERE w * next > 2 * source_size))
        / (SELECT sum(w) FROM o WHERE w * next <= 2 * source_size)
      FROM lv WHERE next > level AND (SELECT count(*) FROM o WHERE w * next <= 2 * source_size) > 0),
    t AS (SELECT source, source_size,
                 least(w * (SELECT max(next) FROM lv), 2.0 * source_size)::DOUBLE AS target FROM o),
    x AS (SELECT d.*, t.source_size, t.target,
                 CASE WHEN t.source_size > 0 THEN floor(target / t.source_size) ELSE 0 END AS whole,
                 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS behind
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, source,
      CAST(whole + CASE WHEN target - whole * source_size > 0
                         AND behind + size / 2 <= target - whole * source_size
                   THEN 1 ELSE 0 END AS BIGINT) AS repeats,
      CAST(size * (whole + CASE WHEN target - whole * source_size > 0
                         AND behind + size / 2 <= target - whole * source_size
                   THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM x""",
)
def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op2_vantage_point_search",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    d AS (SELECT q.vec_id AS query_id, v.vec_id,
        sqrt(list_reduce(list_transform(list_zip(q.e, v.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])),
                         lambda a, b: a + b)) AS score
      FROM v q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT) AS rank
          FROM d)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
)
def vector_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_of_step(table(spark, sf_dir, "embeddings"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    """List of canonical lines, by the same fixed values as the operator."""
    folded = (
        f"regexp_replace(lower(translate(coalesce({text}, ''), '©' || chr(13), 'c' || chr(10))), "
        r"'[^\p{L}\p{N}\n]+', ' ', 'g')"
    )
    spelled = f"' ' || replace(replace({folded}, chr(10), ' ' || chr(10) || ' '), ' ', '  ') || ' '"
    for old, new in SPELLINGS:
        spelled = f"replace({spelled}, ' {old.replace(' ', '  ')} ', ' {new} ')"
    return (
        f"list_filter(list_transform(string_split({spelled}, chr(10)), "
        "lambda x: replace(trim(x), '  ', ' ')), "
        "lambda x: x <> '' AND NOT regexp_matches(x, '^(copyright|c|all rights reserved)( |$)'))"
    )


@query(
    "op5_license_scan",
    f"""WITH k AS (SELECT sha256(array_to_string({_canonical_sql("t")}, ' ')) AS digest, min(l) AS license
      FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN)}) AS x(l, t) GROUP BY 1),
    d AS (SELECT doc_id, {_canonical_sql("text")} AS lines FROM documents),
    w AS (SELECT doc_id, sha256(array_to_string(lines, ' ')) AS digest FROM d),
    h AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT license)), ',') AS notices, count(*) AS n_notices
          FROM (SELECT doc_id, sha256(unnest(lines)) AS digest FROM d) JOIN k USING (digest) GROUP BY doc_id)
    SELECT w.doc_id, w.digest, k.license, coalesce(h.notices, '') AS notices,
           coalesce(h.n_notices, 0) AS n_notices
    FROM w LEFT JOIN k USING (digest) LEFT JOIN h ON h.doc_id = w.doc_id""",
)
def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_suffix_dedup")
def suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))


@query("op13_embedding_whitening")
def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


@query(
    "op11_conversation_trie",
    r"""WITH t AS (
      SELECT conv_id, turn, coalesce(text, '') AS text,
             substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS id
      FROM conversations WHERE conv_id IS NOT NULL),
    o AS (
      SELECT conv_id, list({'id': id, 'n': len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))}
                           ORDER BY turn NULLS FIRST, id) AS ts,
             -- CRC-32 bit by bit: -1 stands for one shift
             xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
                   string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                 lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
                   ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295) % 4 AS h
      FROM t GROUP BY conv_id),
    r AS (SELECT c.conv_id, list_concat(coalesce(b.ts[1 : c.h], []), c.ts[c.h + 1 :]) AS ts
          FROM o c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 20),
    m AS (SELECT conv_id, d, len(ts) AS size, array_to_string(list_transform(ts[1 : d], lambda x: x.id), '') AS p,
                 CASE WHEN d > 0 THEN ts[d].n ELSE 0 END AS n
          FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM r)),
    g AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
                 coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
          FROM m GROUP BY p, d),
    k AS (SELECT substr(p, 1, 32 * (d - 1)) AS p, count(*) AS n FROM g WHERE d > 0 GROUP BY 1),
    f AS (SELECT g.*, coalesce(k.n, 0) AS n_children FROM g LEFT JOIN k USING (p)),
    s AS (SELECT substr(p, 1, 32 * up) AS p, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
          FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM f) GROUP BY 1)
    SELECT f.conv_id, f.d AS depth, above.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
           CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
    FROM f JOIN s USING (p) LEFT JOIN f above ON f.d > 0 AND above.p = substr(f.p, 1, 32 * (f.d - 1))""",
)
def conversation_trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("op12_secret_scan")
def secret_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))
