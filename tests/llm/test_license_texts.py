"""Whole licence documents, as they are found in the wild."""

import json
import textwrap

from celldex.llm import licenses

SCHEMA = "doc_id long, text string"
FULL = {}
for row in map(json.loads, licenses._TABLE.read_text(encoding="utf-8").splitlines()):
    FULL.setdefault(row["license"], row["text"])


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))


def test_whole_licence_files_are_found(spark):
    mit, isc, by = licenses.KNOWN["MIT"][1], licenses.KNOWN["ISC"][0], "\n\nCopyright (c) 2021 Some Body\n\n"
    want = {
        1: ("MIT", "MIT License" + by + wrapped(mit, 78)),
        2: ("MIT", "The MIT License (MIT)" + by + mit),
        3: ("ISC", "ISC License" + by + wrapped(isc, 72)),
        4: ("BSD-3-Clause", "BSD 3-Clause License" + by + "All rights reserved.\n\n" + FULL["BSD-3-Clause"]),
        5: ("BSD-2-Clause", by + FULL["BSD-2-Clause"]),
        6: ("Apache-2.0", FULL["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 Some Body")),
        7: (None, "MIT License" + by + mit.replace("free of charge", "for a fee")),
        8: (None, "MIT License"),
        9: ("MIT", "MIT License" + by + wrapped(mit, 66).replace("\n", "\r\n")),
    } | {100 + i: (k, t) for i, (k, t) in enumerate(sorted(FULL.items()))}
    assert {"GPL-2.0-only", "GPL-3.0-only", "LGPL-3.0-only", "MPL-2.0", "Unlicense", "Zlib"} <= set(FULL)
    got = {x["doc_id"]: x["license"] for x in licenses.license_scan(spark.createDataFrame([(i, t) for i, (_, t) in want.items()], SCHEMA), licenses.known(spark)).collect()}
    assert got == {i: k for i, (k, _) in want.items()}


def test_no_text_is_known_by_two_names(spark):
    both = licenses.known(spark).select(licenses.forms(licenses.F.col("text"))[0].alias("form"), "license").groupBy("form").agg(licenses.F.count_distinct("license").alias("n"))
    assert both.where("n > 1").count() == 0 and both.count() < licenses.MOST_KNOWN
