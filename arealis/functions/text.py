"""Text functions: casing, clean-up, slugs, metric names and HXL tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the base letters slugs use for them.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
BASE = "aaaaaaceeeeiiiinoooooouuuuyyAAAAAACEEEEIIIINOOOOOOUUUUY"


def title_case(text: Column) -> Column:
    """Upper-case each first letter of a run of cased letters, lower-case the rest.

    ``initcap`` only starts words at blanks; here anything but a letter with case does.  Such starts
    inside a word get a mark and a blank in front, which are taken away afterwards.
    """
    inside = F.regexp_replace(text, r"(?<=[^\p{Lu}\p{Ll}\p{Lt} ])(?=[\p{Lu}\p{Ll}\p{Lt}])", "\ue000 ")
    return F.replace(F.initcap(inside), F.lit("\ue000 "), F.lit(""))


def keep_alphanumeric(text: Column) -> Column:
    """Letters and digits of any script, everything else removed."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "")


def slug(text: Column, separator: str = "_") -> Column:
    """Lower-case ASCII words joined by ``separator``."""
    ascii_text = F.translate(F.replace(text, F.lit("®"), F.lit("(r)")), ACCENTED, BASE)
    no_thousands = F.regexp_replace(ascii_text, r"(?<=\d),(?=\d)", "")
    words = F.regexp_replace(F.lower(no_thousands), "[^a-z0-9]+", " ")
    return F.replace(F.trim(words), F.lit(" "), F.lit(separator))


def join_key(*keys: Column, separator: str = "_") -> Column:
    """Metric column name from the pivot keys; null if any key is null."""
    parts = [k.cast("string") for k in keys]
    any_null = parts[0].isNull()
    for part in parts[1:]:
        any_null = any_null | part.isNull()
    return F.when(~any_null, F.trim(F.concat_ws(separator, *parts)))


def hxl_population_tag(names: list[str], values: list[Column]) -> Column:
    """``#population+Name_Value+...`` with both sides reduced to letters and digits."""
    parts = [
        F.concat(
            keep_alphanumeric(F.lit(name)),
            F.lit("_"),
            keep_alphanumeric(value.cast("string")),
        )
        for name, value in zip(names, values)
    ]
    return F.concat_ws("+", F.lit("#population"), *parts)


def hxl_population_tag_from_arrays(names: Column, values: Column) -> Column:
    """The same tag when names and values are array columns of equal length."""
    pairs = F.zip_with(
        names,
        values,
        lambda n, v: F.concat(keep_alphanumeric(n), F.lit("_"), keep_alphanumeric(v)),
    )
    return F.concat(F.lit("#population+"), F.array_join(pairs, "+"))


def human_name(names: list[str], values: list[Column]) -> Column:
    """``Variable: 'n'; Value: 'v'`` for each pair, joined by ``; ``."""
    parts = [
        F.concat(F.lit(f"Variable: '{n}'; Value: '"), v.cast("string"), F.lit("'"))
        for n, v in zip(names, values)
    ]
    return F.concat_ws("; ", *parts)


def human_name_from_arrays(names: Column, values: Column) -> Column:
    pairs = F.zip_with(
        names,
        values,
        lambda n, v: F.concat(
            F.lit("Variable: '"), n, F.lit("'; Value: '"), v, F.lit("'")
        ),
    )
    return F.array_join(pairs, "; ")


def hxl_universe_tag(universe: Column, path: Column) -> Column:
    """``#Universe+Step+Step`` from a universe and a ``|``-separated path."""
    steps = F.transform(F.split(path, r"\|"), lambda s: keep_alphanumeric(title_case(s)))
    return F.concat(
        F.lit("#"), keep_alphanumeric(title_case(universe)), F.lit("+"), F.array_join(steps, "+")
    )


def survey_human_name(
    universe: Column, table: Column, year: Column, period: Column, variable: Column
) -> Column:
    return F.concat_ws(", ", universe, table, year.cast("string"), period, variable)


def key_value_description(names: list[str], values: list[Column]) -> Column:
    """``Key: k, Value: v`` for each pair, joined by ``; ``."""
    parts = [
        F.concat(F.lit(f"Key: {n}, Value: "), F.coalesce(v.cast("string"), F.lit("None")))
        for n, v in zip(names, values)
    ]
    return F.concat_ws("; ", *parts)


def description_to_names(description: Column, exceptions: dict[str, list[str]]) -> Column:
    """Pivot-level names out of ``A by B by C``, last first, title-cased, no blanks.

    ``exceptions`` lists the descriptions whose names are given outright.
    """
    split = F.reverse(F.split(description, " by "))
    chosen = split
    for text, names in exceptions.items():
        chosen = F.when(
            description == text, F.array(*[F.lit(n) for n in names])
        ).otherwise(chosen)
    return F.transform(chosen, lambda n: F.regexp_replace(title_case(n), r"\s", ""))


def remove_prefix(text: Column, prefix: str) -> Column:
    return F.when(
        text.startswith(prefix), F.substring(text, len(prefix) + 1, 2147483647)
    ).otherwise(text)


def last_part(text: Column, separator: str) -> Column:
    """The piece after the last separator."""
    return F.substring_index(text, separator, -1)
