"""Licence texts, headings, headers and tags; cosines against a plain version."""

import collections
import math
import re
import textwrap

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemill.llm import licenses
from tidemill.llm.licenses import ALL, Templates, license_scan, scanned
from tidemill.llm.shared import text_bytes
from tidemill.llm.words import plain_spans

BODY = {name: [t for n, t in licenses.BODIES if n == name] for name in dict(licenses.BODIES)}


def wrapped(*paragraphs):
    return "\n\n".join(textwrap.fill(p, 72) for p in paragraphs) + "\n"


def bsd(*clauses):
    marked = [f"{k + 1}. {c}" for k, c in enumerate(clauses)]
    return wrapped("Copyright (c) 2020, Some Holder", licenses._BSD_CLAUSES[0], *marked, licenses._BSD_WARRANTY)


FILES = {
    "mit/LICENSE": (wrapped("MIT License", "Copyright (c) 2021 Some Author", *BODY["MIT"]), "MIT"),
    "untitled/LICENSE": (wrapped("Copyright (c) 2021 Some Author", *BODY["MIT"]), "MIT"),
    "isc/LICENSE": (wrapped("ISC License", "Copyright (c) 2021 Some Author", *BODY["ISC"]), "ISC"),
    "bsd2/LICENSE": (bsd(*licenses._BSD_CLAUSES[1:]), "BSD-2-Clause"),
    "bsd3/LICENSE": (bsd(*licenses._BSD_CLAUSES[1:], licenses._BSD_NAMES), "BSD-3-Clause"),
    "apache/LICENSE": ("                 Apache License\n           Version 2.0, January 2004\n        http://www.apache.org/licenses/\n\n"
                       "   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n" + "Other terms follow here at length. " * 200, "Apache-2.0"),
    "gpl/COPYING": ("        GNU GENERAL PUBLIC LICENSE\n           Version 3, 29 June 2007\n\n" + "Everyone may copy the words of it. " * 200, "GPL-3.0"),
    "gpl2/COPYING": ("        GNU GENERAL PUBLIC LICENSE\n           Version 2, June 1991\n\n" + "Everyone may copy the words of it. " * 200, "GPL-2.0"),
}


def test_licence_files_are_recognised_and_inherited(spark):
    rows = [(p, t) for p, (t, _) in FILES.items()] + [(p.split("/")[0] + "/src/deep/main.c", "int main;") for p in FILES]
    got = {r.path: r for r in license_scan(spark.createDataFrame(rows, "path string, text string"), F.col("path")).collect()}
    assert {p: got[p].license for p in FILES} == {p: name for p, (_, name) in FILES.items()}
    assert {p: got[p.split("/")[0] + "/src/deep/main.c"].effective for p in FILES} == {p: name for p, (_, name) in FILES.items()}


def test_headings_tags_headers_and_texts_without_licence(spark):
    code = "\n\n" + "x = compute(y)\n" * 60
    texts = {
        "MIT License": "MIT", BODY["MIT"][0]: "MIT", "SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: GPL-3.0-or-later" + code: "GPL-3.0",
        "// SPDX-License-Identifier: Apache-2.0" + code: "Apache-2.0", wrapped(*BODY["Apache-2.0"]) + code: "Apache-2.0",
        wrapped(BODY["GPL-2.0"][0]) + code: "GPL-2.0", licenses._BSD_CLAUSES[0]: "BSD-3-Clause",
        "The software is fine, and the license of it is a topic of its own. " * 5 + code: None, "License": None, "": None, None: None,
        "All rights of use are granted to the members of the club, for free. " * 50: None,
    }
    rows = list(texts)
    got = scanned(spark.createDataFrame(list(enumerate(rows)), "id int, text string")).collect()
    assert {rows[r.row.id]: r.license for r in got} == texts and len(got) == len(rows)


def test_cosines_equal_a_plain_version():
    cut = lambda t: re.findall("[a-z0-9]+", t.lower())
    df = collections.Counter(w for _, t in ALL for w in set(cut(t)))
    weight = lambda w: math.log((1 + len(ALL)) / (1 + df[w])) + 1

    def vector(t):
        v = {w: c * weight(w) for w, c in collections.Counter(cut(t)).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    templates, vectors = Templates(), [vector(t) for _, t in ALL]
    units = [t for _, t in ALL] + [f"some other words {t} and more" for _, t in ALL] + ["nothing at all like it", "the license of the software"]
    words, _, _, unit = plain_spans(*text_bytes(pa.array(units)))
    plain = [max(sum(x * v.get(w, 0) for w, x in vector(t).items()) for v in vectors) for t in units]
    np.testing.assert_allclose(templates.best(words, unit, len(units))[0], plain, atol=1e-9)
    pruned = templates.best(words, unit, len(units), 0.75)[0]
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(pruned, plain) if b >= 0.75) and all(a < 0.75 for a, b in zip(pruned, plain) if b < 0.7499)
