"""Licence scan: canonical digests of entire texts joined to those of known licences.

Case, punctuation, white space, copyright lines and equivalent spellings do not matter.  The texts that
are looked up are the whole document and every line of it that is a text of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word pairs that count as the same spelling.
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("licencing", "licensing"),
    ("sub license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("acknowledgements", "acknowledgments"),
    ("analogue", "analog"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("modelled", "modeled"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("recognised", "recognized"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https", "http"),
    ("merchantibility", "merchantability"),
]

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n"
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
    "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted"
)

# Licence texts and the notices that name a licence, with their public identifiers.
KNOWN = [
    (
        "MIT",
        "MIT License\n"
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        f"ISC License\n{_PERMISSION}, provided that the above copyright notice and this permission notice "
        f"appear in all copies.\n{_WARRANTY}",
    ),
    ("0BSD", f"Zero-Clause BSD\n{_PERMISSION}.\n{_WARRANTY}"),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    (
        "BSD-3-Clause",
        _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be "
        "used to endorse or promote products derived from this software without specific prior written "
        "permission.\n" + _BSD_TAIL,
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software.\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions:\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required.\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software.\n"
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]

_COPYRIGHT = r"^(copyright|c|all rights reserved)( |$)"


def canonical_lines(text: Column) -> Column:
    """Lines in canonical form, without blank ones and copyright lines."""
    folded = F.regexp_replace(
        F.lower(F.translate(F.coalesce(text, F.lit("")), "©\r", "c\n")), r"[^\p{L}\p{N}\n]+", " "
    )
    # every word gets a space of its own on both sides, so that neighbours can both be replaced
    apart = F.concat(
        F.lit(" "), F.replace(F.replace(folded, F.lit("\n"), F.lit(" \n ")), F.lit(" "), F.lit("  ")), F.lit(" ")
    )
    spelled = reduce(
        lambda t, pair: F.replace(t, F.lit(f" {pair[0].replace(' ', '  ')} "), F.lit(f" {pair[1]} ")),
        SPELLINGS,
        apart,
    )
    lines = F.transform(
        F.split(spelled, "\n"), lambda x: F.replace(F.trim(x), F.lit("  "), F.lit(" "))
    )
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(_COPYRIGHT))


def known_digests(spark: SparkSession) -> DataFrame:
    """license, digest and canonical size; as many rows as there are known texts."""
    rows = spark.createDataFrame(KNOWN, "license string, text string")
    whole = F.array_join(canonical_lines(F.col("text")), " ")
    return (
        rows.select("license", whole.alias("text"))
        .groupBy(F.sha2("text", 256).alias("digest"))
        .agg(F.min("license").alias("license"), F.max(F.length("text")).alias("size"))
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, license, notices, n_notices.

    ``digest`` belongs to the whole canonical text, ``license`` is the known licence that the whole text
    is, ``notices`` the sorted distinct licences that whole lines are, parted by commas, ``n_notices`` the number of such
    lines.  Null text counts as empty and matches nothing.  Rows that repeat a doc_id get what their own
    text says; other columns are not read.
    """
    known = known_digests(docs.sparkSession)
    # lines longer than any known text cannot be one
    longest = known.agg(F.max("size")).first()[0]
    lines = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    whole = F.array_join("lines", " ")
    short = F.filter("lines", lambda x: F.length(x) <= longest)
    scanned = lines.select(
        "doc_id",
        F.sha2(whole, 256).alias("digest"),
        F.transform(short, lambda x: F.sha2(x, 256)).alias("prints"),
    )
    texts = scanned.select(
        "doc_id",
        F.col("digest").alias("whole"),
        F.explode(
            F.concat(
                F.array(F.struct(F.lit(True).alias("entire"), F.col("digest"))),
                F.transform("prints", lambda x: F.struct(F.lit(False).alias("entire"), x.alias("digest"))),
            )
        ).alias("part"),
    ).select("doc_id", "whole", "part.entire", "part.digest")
    # The known texts are a fixed list, so the join ships them to the rows.
    hits = (
        texts.join(F.broadcast(known.drop("size")), "digest")
        .groupBy(F.col("doc_id").alias("hit_id"), "whole")
        .agg(
            F.max(F.when(F.col("entire"), F.col("license"))).alias("license"),
            F.array_join(
                F.array_sort(F.collect_set(F.when(~F.col("entire"), F.col("license")))), ","
            ).alias("notices"),
            F.count(F.when(~F.col("entire"), 1)).alias("n_notices"),
        )
    )
    return scanned.select("doc_id", "digest").join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("whole")), "left"
    ).select(
        "doc_id",
        "digest",
        "license",
        F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
    )
