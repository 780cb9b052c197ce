"""License scans by canonical digest.

A text's canonical form is lower case, without copyright lines, with equivalent spellings made one and
every run of punctuation and white space as one space.  Its SHA-256 is looked up among
the digests of known licences by a hash join.  Whole documents are looked up, and each line of a
document as a text of its own.  All of it is Spark SQL functions.

Known are `KNOWN` and the full texts of the table known_licenses.jsonl (license, text), each also with its
usual title lines, with the line "All rights reserved." after them, as one line a paragraph, and with lines
broken at `WIDTHS`: as copyright lines are left out, a text has another form where a line begins with that word.
The long ones, which have no title of their own in `TITLES`, are looked up as printed and unbroken only.

Digests of known texts are broadcast up to `MOST_KNOWN` of them, joined by shuffle beyond.  Every row is
a document of its own, repeated ids and null ids too; a task puts a row's lines together again by its
place in the scan, before anything is shuffled.  Null text has no lines.  Empty canonical forms match nothing.
"""

from __future__ import annotations

import json
import re
import textwrap
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_KNOWN = 20_000

# Word beginnings that licence texts spell in two ways, and the one kept.
SPELLINGS = {
    " licenc": " licens",
    " sublicenc": " sublicens",
    " organis": " organiz",
    " authoris": " authoriz",
    " recognis": " recogniz",
    " favour": " favor",
    " behaviour": " behavior",
    " acknowledgement": " acknowledgment",
    " judgement": " judgment",
    " artefact": " artifact",
    " merchantibility": " merchantability",
    " whilst ": " while ",
    " per cent ": " percent ",
}

# Public licence texts and the one-line notices that stand for a licence; the SQL's table.
KNOWN = {
    "LicenseRef-all-rights-reserved": ["All rights reserved."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "GPL-3.0-only": ["This work is licensed under the GNU General Public License, version 3."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n'
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
}

# What stands above a licence's text, if anything does.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License", "Zero-Clause BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License", "BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License", "BSD License", "New BSD License", "The BSD License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
}
WIDTHS = range(60, 101)
_TABLE = Path(__file__).with_name("known_licenses.jsonl")
_BREAK = r"\n\s*\n|\n(?=\s*(?:[*-]|\d+\.)\s)"

# Punctuation and white space that count as a space.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\t\n\x0b\f\r\xa0«»“”‘’„–—…•·¿¡"
_COPYRIGHT = r"^[ \t]*(copyright|\(c\)|©)"
_MARKS = "[" + re.escape(PUNCTUATION) + "]+"


def canonical(line: Column) -> Column:
    """Of one line; a copyright line's is empty."""
    low = F.lower(line)
    out = F.regexp_replace(F.concat(F.lit(" "), F.regexp_replace(low, _MARKS, " "), F.lit(" ")), " {2,}", " ")
    for a, b in SPELLINGS.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(low.rlike(_COPYRIGHT), F.lit("")).otherwise(F.trim(out))


def forms(text: Column) -> Column:
    """The canonical form of a text, which is that of its lines joined, followed by its lines'."""
    lines = F.transform(F.split(text, "\n", -1), canonical)
    return F.transform(F.array(lines), lambda x: F.concat(F.array(F.array_join(F.filter(x, lambda y: y != ""), " ")), x))[0]


def _layouts(text: str, widths) -> list[str]:
    """The text as it is, unbroken and broken at some widths; those that leave out the same copyright lines once."""
    paragraphs = [" ".join(p.split()) for p in re.split(_BREAK, text)]
    out = {}
    for lines in [text.split("\n"), paragraphs, *([x for p in paragraphs for x in textwrap.wrap(p, w)] for w in widths)]:
        out.setdefault(" ".join(" ".join(x for x in lines if not re.search(_COPYRIGHT, x.lower())).split()), "\n".join(lines))
    return list(out.values())


def known_texts() -> list[tuple[str, str]]:
    """license, text of all that is looked up."""
    rows = [(k, t) for k, texts in sorted(KNOWN.items()) for t in texts]
    rows += [(x["license"], x["text"]) for x in map(json.loads, _TABLE.read_text(encoding="utf-8").splitlines())]
    out = []
    for name, text in rows:
        if "\n" not in text:
            out.append((name, text))
            continue
        titles = TITLES.get(name)
        above = [f"{t}\n{r}" for t in ["", *titles] for r in ("", "All rights reserved.\n")] if titles else [""]
        out += [(name, a + x) for x in _layouts(text, WIDTHS if titles else ()) for a in above]
    return out


def known(spark: SparkSession) -> DataFrame:
    names, texts = zip(*known_texts(), strict=True)
    return spark.createDataFrame(pa.table({"license": pa.array(names), "text": pa.array(texts)}))


def license_scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """doc_id, license (of the whole text, or null), n_lines that match, licenses (of lines, sorted, comma-joined)."""
    at = licences.select(forms(F.col("text"))[0].alias("form"), "license").where("form <> ''").groupBy("form").agg(F.min("license").alias("found"))
    at = at.select(F.sha2("form", 256).alias("digest"), "found")
    if at.limit(MOST_KNOWN + 1).count() <= MOST_KNOWN:
        at = F.broadcast(at)
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")).select("row", "doc_id", F.posexplode_outer(forms(F.col("text"))).alias("at", "form"))
    rows = rows.select("row", "doc_id", (F.col("at") == 0).alias("whole"), F.sha2("form", 256).alias("digest")).join(at, "digest", "left")
    named = lambda on: F.when(F.col("whole") == on, F.col("found"))
    return rows.groupBy("row", F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(named(True)).alias("license"),
        F.count(named(False)).alias("n_lines"),
        F.array_join(F.sort_array(F.collect_set(named(False))), ",").alias("licenses"),
    ).drop("row")


def oracle() -> str:
    """The same in DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def form(x: str) -> str:
        out = f"regexp_replace(' ' || regexp_replace(lower({x}), {quote(_MARKS)}, ' ', 'g') || ' ', ' {{2,}}', ' ', 'g')"
        for a, b in SPELLINGS.items():
            out = f"replace({out}, {quote(a)}, {quote(b)})"
        return f"case when regexp_matches(lower({x}), {quote(_COPYRIGHT)}) then '' else trim({out}) end"

    each = lambda t: f"list_transform(string_split({t}, chr(10)), lambda x: {form('x')})"
    whole = lambda t: f"array_to_string(list_filter({each(t)}, lambda y: y <> ''), ' ')"
    values = ", ".join(f"({quote(k)}, {quote(t)})" for k, texts in sorted(KNOWN.items()) for t in texts)
    return f"""
    with known as (select {whole("t")} as form, min(k) as found from (values {values}) v(k, t) group by 1 having form <> ''),
    forms as (
      select doc_id, {whole("text")} as form, true as whole from documents
      union all
      select doc_id, unnest({each("text")}), false from documents
    )
    select doc_id, min(case when whole then found end) as license,
           count(case when not whole then found end) as n_lines,
           coalesce(array_to_string(list_sort(list(distinct found) filter (where not whole and found is not null)), ','), '') as licenses
    from forms left join known using (form) group by doc_id
    """
