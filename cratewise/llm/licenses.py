"""License scans (operator 8): digests of whole canonical texts, looked up among known licences.

Native: DataFrame functions only. A text in canonical form is in lower case, without copyright lines, with
one spelling of equivalent words, and with single spaces for punctuation and white space. The SHA-256 of a
document's canonical form is joined to that of the known texts. Short notices stand on a line of their own
within a document, so every line is taken as a text as well.

Defined results: NULL and empty texts have the canonical form '' and match nothing. Repeated rows are
judged each. Known texts with the same canonical form count as the one whose name sorts first. A known text
without a name or a word matches nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.operators.skew import HotKeys
from cratewise.sources.stage import Stage

# Known digests beyond this number are joined by shuffle; up to it they are broadcast, 64 hex digits each.
BROADCAST_KNOWN = 10_000

# A line that states a copyright, and spellings that count as the same.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(copyright|\(c\)|©)[^\n]*"
EQUIVALENT = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("organisation", "organization"),
    ("merchantibility", "merchantability"),
    ("https://", "http://"),
    ("&", " and "),
)

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Known licence texts and notices, without their copyright lines.
KNOWN: dict[str, str] = {
    "MIT": (
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies.\n\n" + _AS_IS
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\n" + _AS_IS
    ),
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + _BSD_NAMES + _BSD_TAIL,
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "All rights reserved notice": "All rights reserved.",
}


def canonical_lines(text: Column) -> Column:
    """Canonical form with line feeds kept."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, COPYRIGHT_LINE, "\n")
    for spelling, usual in EQUIVALENT:
        out = F.replace(out, F.lit(spelling), F.lit(usual))
    return F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")


def joined(lines: Column) -> Column:
    """The whole canonical text of :func:`canonical_lines`."""
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def known_digests(spark: SparkSession, known: Mapping[str, str] | DataFrame) -> DataFrame:
    """(digest, license) of known texts, given by name or as a table (license, text); each digest once."""
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame(list(known.items()), "license string, text string")
    form = joined(canonical_lines(F.col("text")))
    named = rows.filter("license is not null").select("license", form.alias("form")).filter("form != ''")
    return named.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, known: Mapping[str, str] | DataFrame = KNOWN, text: str = "text") -> DataFrame:
    """Per document: doc_id, digest of its canonical text, the licence that it is, and the known texts that
    stand on its lines (sorted, each once).

    ``known`` may hold any number of texts; as a table (license, text) they never pass the driver.
    """
    stage = Stage(docs.sparkSession)
    digests = stage.save("known", known_digests(docs.sparkSession, known))
    lines = docs.select("doc_id", canonical_lines(F.col(text)).alias("lines"))
    split = F.filter(F.transform(F.split("lines", "\n", -1), lambda line: F.trim(line)), lambda line: line != "")
    whole = F.sha2(joined(F.col("lines")), 256).alias("digest")
    if digests.count() > BROADCAST_KNOWN:
        own = F.array_distinct(F.transform(split, lambda line: F.sha2(line, 256)))
        return _joined_scan(stage, lines.select("doc_id", whole, own.alias("own")), digests)
    # The few known digests are a constant map, so that lines need not leave their row.
    pairs = [F.lit(x) for r in digests.orderBy("digest").collect() for x in (r.digest, r.license)]
    names = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    found = F.filter(F.transform(split, lambda line: names[F.sha2(line, 256)]), lambda name: name.isNotNull())
    scanned = lines.select("doc_id", whole, F.array_join(F.array_sort(F.array_distinct(found)), ", ").alias("notices"))
    return scanned.join(F.broadcast(digests), "digest", "left").select("doc_id", "digest", "license", "notices")


def _joined_scan(stage: Stage, scanned: DataFrame, digests: DataFrame) -> DataFrame:
    """:func:`license_scan` of (doc_id, digest, own digests of the lines) by joins.

    Only digests that are known and occur meet the documents, and hot ones are split. What a document finds is
    bounded by its own lines.
    """
    scanned = stage.save("scanned", scanned.withColumn("row", F.monotonically_increasing_id()))
    asked = scanned.select("row", F.lit(True).alias("whole"), "digest").unionByName(
        scanned.select("row", F.lit(False).alias("whole"), F.explode("own").alias("digest"))
    )
    present = stage.save("present", digests.join(asked.select("digest").distinct(), "digest", "left_semi"))
    if present.count() <= BROADCAST_KNOWN:
        hits = asked.join(F.broadcast(present), "digest")
    else:
        asked = stage.save("asked", asked)
        hits = HotKeys.find({"digest": asked.select("digest")}).join("digest", asked, present, "digest", spread=["row"])
    found = hits.groupBy("row").agg(
        F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ", ").alias("notices"),
    )
    return scanned.select("row", "doc_id", "digest").join(found, "row", "left").select(
        "doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices")
    )


def license_sql(known: Mapping[str, str] = KNOWN) -> str:
    """DuckDB SQL with the same result over ``documents``."""
    form = f"regexp_replace(lower(coalesce(text, '')), '{COPYRIGHT_LINE}', chr(10), 'g')"
    for spelling, usual in EQUIVALENT:
        form = f"replace({form}, '{spelling}', '{usual}')"
    form = f"regexp_replace({form}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')".replace("\\\\", "\\")
    whole = lambda lines: f"trim(regexp_replace({lines}, '[ \\n]+', ' ', 'g'))"
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in known.items())
    return f"""
with known as (
    select sha256(form) as digest, min(license) as license
    from (select license, {whole(form)} as form from (values {rows}) t(license, text)) where form != '' group by 1
), docs as (
    select row_number() over () as rid, doc_id, {form} as lines from documents
), notices as (
    select rid, string_agg(distinct license, ', ' order by license) as notices
    from (select rid, sha256(trim(unnest(string_split(lines, chr(10))))) as digest from docs) join known using (digest)
    group by rid
)
select doc_id, sha256({whole('lines')}) as digest, license, coalesce(notices, '') as notices
from docs left join notices using (rid) left join known on known.digest = sha256({whole('lines')})
"""
