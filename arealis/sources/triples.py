"""Catalogue triples from landed N-Triples text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.urls import last_segment, swap_suffix, url_path
from arealis.operators.ordered import preferred
from arealis.sources.delimited import FORMAT_ROOT, FORMAT_SUFFIX

# Vocabulary terms of the catalogue.
DATASET = "http://www.w3.org/ns/dcat#dataset"
DISTRIBUTION = "http://www.w3.org/ns/dcat#distribution"
LANDING_PAGE = "http://www.w3.org/ns/dcat#landingPage"
TITLE = "http://purl.org/dc/terms/title"
DESCRIPTION = "http://purl.org/dc/terms/description"
FORMAT = "http://purl.org/dc/terms/format"
LANGUAGE = "http://purl.org/dc/terms/language"
NOTATION = "http://www.w3.org/2004/02/skos/core#notation"
ISO_639_1 = "http://publications.europa.eu/ontology/euvoc#ISO_639_1"

LANGUAGE_ORDER = ["en", "fr", "de", "nl"]

# Escaped backslashes and quotes are set aside as single characters, so a literal ends at its next quote
# and plain runs keep the matcher flat however long it is.
_BACKSLASH, _QUOTE = "\u0000", "\u0001"
_OBJECT = r'<([^>]*)>|(_:\S*[^\s.])|"([^"]*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?'
_LINE = rf"(?s)^\s*(?:<([^>]*)>|(_:\S+))\s+<([^>]*)>\s+(?:{_OBJECT})\s*\.\s*(?:#.*)?$"
_NO_TRIPLE = r"^\s*(?:#.*)?$"

# Escapes of one character.
ESCAPES = {"\\t": "\t", "\\b": "\b", "\\n": "\n", "\\r": "\r", "\\f": "\f", "\\'": "'"}
_CODE = r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}"
# Surrogates and what lies beyond the last code point stand for no character.
_NO_CODE = r"\\u[dD][89a-fA-F]|\\U(?!0010|000[0-9A-Fa-f])|\\U0000[dD][89a-fA-F]"


def _set_aside(line: Column) -> Column:
    whole = F.replace(line, F.lit("\\\\"), F.lit(_BACKSLASH))
    return F.replace(whole, F.lit('\\"'), F.lit(_QUOTE))


def _unescaped(text: Column) -> Column:
    """Every escape of a term read once, from left to right."""

    def put_back(plain: Column) -> Column:
        for code, character in ESCAPES.items():
            plain = F.replace(plain, F.lit(code), F.lit(character))
        return F.translate(plain, _BACKSLASH + _QUOTE, '\\"')

    def piece(p: Column) -> Column:
        digits = F.lpad(F.substring(p, 3, 8), 8, "0")
        return F.when(p.rlike(f"^(?:{_CODE})$"), F.decode(F.unhex(digits), "UTF-32")).otherwise(put_back(p))

    pieces = F.regexp_extract_all(text, F.lit(rf"({_CODE}|(?:(?!{_CODE})\\.)|[^\\]+)"), F.lit(1))
    return F.when(text.rlike(_CODE), F.array_join(F.transform(pieces, piece), "")).otherwise(put_back(text))


def _readable(line: Column) -> Column:
    """A triple whose escapes all stand for a character."""
    marked = _set_aside(line)
    unknown = rf"\\(?!['tbnrf]|u[0-9A-Fa-f]{{4}}|U[0-9A-Fa-f]{{8}})"
    return marked.rlike(_LINE) & ~marked.rlike(unknown) & ~marked.rlike(_NO_CODE)


def parse_triple_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """N-Triples lines -> ``(s, p, o, lang, datatype)``; blank and comment lines drop out.

    A comment may follow a triple.  Lines that are no triple are those of :func:`rejected_lines`.
    """
    marked = _set_aside(F.col(text))
    parts = lines.filter(_readable(F.col(text))).select(
        *(F.regexp_extract(marked, _LINE, k).alias(f"_{k}") for k in range(1, 9)),
        marked.rlike(r'(?s)^\s*(?:<[^>]*>|_:\S+)\s+<[^>]*>\s+"').alias("_literal"),
    )
    node = F.concat("_4", "_5")
    return parts.select(
        _unescaped(F.concat("_1", "_2")).alias("s"),
        _unescaped(F.col("_3")).alias("p"),
        _unescaped(F.when(F.col("_literal"), F.col("_6")).otherwise(node)).alias("o"),
        F.nullif(F.col("_7"), F.lit("")).alias("lang"),
        F.nullif(F.col("_8"), F.lit("")).alias("datatype"),
    )


def rejected_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines that are neither a triple nor blank nor a comment."""
    line = F.col(text)
    return lines.filter(~line.rlike(_NO_TRIPLE) & ~_readable(line))


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return parse_triple_lines(spark.read.text(path))


def objects(triples: DataFrame, predicate: str) -> DataFrame:
    """Distinct ``(s, o, lang, datatype)`` of one predicate."""
    return (
        triples.filter(F.col("p") == predicate).select("s", "o", "lang", "datatype").distinct()
    )


def ranked_languages(requested: str) -> list[str]:
    return [requested, *[code for code in LANGUAGE_ORDER if code != requested]]


def text_by_language(triples: DataFrame, predicate: str, requested: str = "en") -> DataFrame:
    """One text per subject: the requested language, else en, fr, de, nl.

    A subject with none of them gets a null text; literals without a language
    tag are not eligible.  Repeated triples do not matter to the pick, so the
    texts are folded on the map side instead of being made distinct first.
    """
    return (
        triples.filter(F.col("p") == predicate)
        .groupBy("s")
        .agg(
            preferred(F.col("o"), F.col("lang"), ranked_languages(requested), F.col("o")).alias(
                "text"
            )
        )
    )


def landing_pages(
    triples: DataFrame, language_codes: DataFrame, requested: str = "en"
) -> DataFrame:
    """Landing page per dataset by language.

    The page node names its language as a node; ``language_codes`` are the
    triples that give each language node its two-letter code.
    """
    codes = language_codes.filter(
        (F.col("p") == NOTATION) & (F.col("datatype") == ISO_639_1)
    ).select(F.col("s").alias("language_node"), F.col("o").alias("code"))
    spoken = objects(triples, LANGUAGE).select(
        F.col("s").alias("page"), F.col("o").alias("language_node")
    )
    return (
        objects(triples, LANDING_PAGE)
        .select("s", F.col("o").alias("page"))
        .join(spoken, "page")
        .join(codes, "language_node")
        .groupBy("s")
        .agg(
            preferred(
                F.col("page"), F.col("code"), ranked_languages(requested), F.col("page")
            ).alias("page")
        )
    )


def distributions(triples: DataFrame) -> DataFrame:
    """Chosen file per dataset: ``(s, url, member, format)``.

    Formats are ranked; two files of one format are settled by URL.  A zipped
    file is expected to hold a member with the suffix of its format.
    """
    formats = objects(triples, FORMAT).select(
        F.col("s").alias("url"), F.replace("o", F.lit(FORMAT_ROOT), F.lit("")).alias("format")
    )
    found = (
        objects(triples, DISTRIBUTION)
        .select("s", F.col("o").alias("url"))
        .join(formats, "url")
        .groupBy("s")
        .agg(
            preferred(
                F.struct("url", "format"), F.col("format"), list(FORMAT_SUFFIX), F.col("url")
            ).alias("pick")
        )
        .select("s", "pick.url", "pick.format")
    )
    return found.withColumn("member", zipped_member(F.col("url"), F.col("format")))


def zipped_member(url: Column, fmt: Column) -> Column:
    """File name in the URL, with ``.zip`` replaced by the suffix of the format."""
    name = last_segment(url_path(url))
    chosen = name
    for known, suffix in FORMAT_SUFFIX.items():
        chosen = F.when(
            name.endswith(".zip") & (fmt == known), swap_suffix(name, suffix)
        ).otherwise(chosen)
    return chosen
