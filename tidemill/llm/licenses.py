"""Licence scan: TF-IDF cosine of lines and files to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import ID_ROWS, in_batches, named, rows, slices, stored, text_bytes
from tidemill.llm.words import plain_spans

#: Cosine from which a line, sentence or file is taken for a licence notice.
COSINE = 0.75
#: Share of a file's words in its notices from which the file is a licence file of its directory.
FILE_SHARE = 0.25
#: Usual wordings of licence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This software is licensed under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright: CC0 1.0 Universal"),
    ("Proprietary", "Copyright. All rights reserved"),
)


_GRANT = "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.",
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission."
)
_GPL_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
)
_GPL_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
#: Paragraphs of licence texts and of the headers that they ask for.
BODIES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell " + _GRANT),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
            "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
            "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
            "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
            "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", " ".join((*_BSD_CLAUSES, _BSD_WARRANTY))),
    ("BSD-3-Clause", " ".join((*_BSD_CLAUSES, _BSD_NAMES, _BSD_WARRANTY))),
    ("BSD-3-Clause", _BSD_NAMES),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You "
                   "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("GPL-3.0", _GPL_HEADER.format(3)),
    ("GPL-2.0", _GPL_HEADER.format(2)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Paragraphs that several licences share. They name a file only if no paragraph of one licence does.
SHARED = (*(("BSD-3-Clause", c) for c in _BSD_CLAUSES), ("BSD-3-Clause", _BSD_WARRANTY), ("GPL-3.0", _GPL_WARRANTY))
#: Headings of licence texts. A file whose first lines are one is a licence file of its directory.
TITLES = (
    ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("MIT", "The MIT License"), ("ISC", "ISC License"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Apache-2.0", "Apache License"), ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"), ("CC0-1.0", "CC0 1.0 Universal"),
)
_TAGGED = ("MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense")
TAGS = tuple((name, f"SPDX-License-Identifier: {name}{end}") for name in _TAGGED for end in ("", "-only", "-or-later")[: 3 if "GPL" in name else 1])
ALL = (*TEMPLATES, *BODIES, *TITLES, *TAGS, *SHARED)


class Templates:
    """Unit vectors of the templates over their words; a word of no template has the largest weight."""

    def __init__(self, templates=ALL, titles=TITLES, shared=SHARED):
        self.title = np.array([t in titles for t in templates])
        self.shared = np.array([t in shared for t in templates])
        self.names = [name for name, _ in templates]
        hashes, _, _, text = plain_spans(*text_bytes(pa.array([t for _, t in templates])))
        self.vocabulary, column = np.unique(hashes, return_inverse=True)
        counts = np.zeros((len(templates), len(self.vocabulary)))
        np.add.at(counts, (text, column), 1)
        n = len(templates)
        self.weight = np.log((1 + n) / (1 + (counts > 0).sum(0))) + 1
        self.unknown = np.log(1 + n) + 1
        vectors = counts * self.weight
        self.vectors = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))

    def best(self, words: np.ndarray, unit: np.ndarray, n: int, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Best cosine and its template of each of ``n`` units, given the words and the unit of each.

        Units that cannot reach ``least``, because too much of their weight is in words of no template, get 0.
        """
        order = np.lexsort((words, unit))
        words, unit = words[order], unit[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (unit[1:] != unit[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(words)))
        words, unit = words[first], unit[first]
        column = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        known = self.vocabulary[column] == words
        value = count * np.where(known, self.weight[column], self.unknown)
        norm = np.sqrt(np.maximum(np.bincount(unit, value * value, minlength=n), 1e-12))
        # No cosine is above the share of the known words in the length of the vector; units below stay out of the product.
        cosine, which = np.zeros(n), np.zeros(n, np.int64)
        known &= (np.sqrt(np.bincount(unit, np.where(known, value * value, 0), minlength=n)) >= (least - 1e-9) * norm)[unit]
        some, row = np.unique(unit[known], return_inverse=True)
        for start in range(0, len(some), 4096):
            part = (row >= start) & (row < start + 4096)
            dense = np.zeros((min(4096, len(some) - start), len(self.vocabulary)))
            dense[row[part] - start, column[known][part]] = value[known][part]
            product = dense @ self.vectors.T / norm[some[start: start + 4096], None]
            cosine[some[start: start + 4096]], which[some[start: start + 4096]] = product.max(1), product.argmax(1)
        return cosine, which


_FOUND = pa.schema([("license", pa.string()), ("cosine", pa.float64()), ("share", pa.float64()), ("titled", pa.bool_())])


def _edges(raw: np.ndarray, start: np.ndarray):
    """Where units end, kind by kind: lines, sentences, paragraphs (line ends before a line without words), whole files."""
    newline = np.flatnonzero(raw == 10)
    words = np.searchsorted(start, newline)
    blank = np.append(words[1:] == words[:-1], False) if len(newline) else np.zeros(0, bool)
    for at in (newline, np.flatnonzero(np.isin(raw, np.frombuffer(b"\n.!?", np.uint8))), newline[blank], newline[:0]):
        edge = np.zeros(len(raw), bool)
        edge[at] = True
        yield edge


def _scan(templates: Templates, threshold: float, schema):
    def run(batches):
        for batch in slices(batches):
            raw, offsets = text_bytes(named(batch, "text"))
            words, start, _, text = plain_spans(raw, offsets)
            n = batch.num_rows
            best, name, share, titled = np.zeros(n), np.full(n, -1), np.zeros(n), np.zeros(n, bool)
            total = np.maximum(np.bincount(text, minlength=n), 1)
            head = np.searchsorted(text, np.arange(n))
            for edge in _edges(raw, start):
                # A unit ends with its text or after an end sign.
                ordinal = np.cumsum(edge)[start] + text * (len(raw) + 1) if len(start) else start
                _, unit = np.unique(ordinal, return_inverse=True)
                units = int(unit.max()) + 1 if len(unit) else 0
                cosine, which = templates.best(words, unit, units, threshold)
                hit = cosine >= threshold
                if not hit.any():
                    continue
                owner = np.zeros(units, np.int64)
                owner[unit] = text
                share = np.maximum(share, np.bincount(text, hit[unit], minlength=n) / total)
                for u in np.flatnonzero(hit):
                    t = owner[u]
                    # A paragraph of one licence goes before one that several share.
                    if name[t] < 0 or (not templates.shared[which[u]], cosine[u]) > (not templates.shared[name[t]], best[t] + 1e-12):
                        best[t], name[t] = cosine[u], which[u]
                    titled[t] |= templates.title[which[u]] and unit[head[t]] == u
            names = [templates.names[k] if k >= 0 else None for k in name]
            yield pa.RecordBatch.from_arrays(
                [named(batch, "row"), pa.array(names, pa.string()), pa.array(best), pa.array(share), pa.array(titled)], ["row", *_FOUND.names]
            )

    return run


def scanned(files: DataFrame, threshold: float = COSINE) -> DataFrame:
    """Every row of ``files`` (with ``text``) as ``row``, with ``license, cosine, share, titled``.

    Lines, sentences, paragraphs and whole files are compared with the templates; the best cosine of at least
    ``threshold`` decides, the first of equal ones, paragraphs that several licences share last. ``share`` is the part
    of the words that stands in matching units of one kind, ``titled`` says that the file begins with the heading of a
    licence. No match, null or empty text: license null, cosine and share 0.
    """
    wide = in_batches(files).select(F.struct(*(F.col(f"`{c}`") for c in files.columns)).alias("row"), "text")
    schema = wide.select("row").schema.add("license", "string").add("cosine", "double").add("share", "double").add("titled", "boolean")
    return wide.mapInArrow(_scan(Templates(), threshold, schema), schema)


def license_scan(files: DataFrame, path: Column, share: float = FILE_SHARE) -> DataFrame:
    """``scanned`` with ``path``, and the licence in force: ``effective`` and the ``directory`` it comes from.

    A file with a licence of its own keeps it (directory null). Another one inherits from the nearest directory above
    it, its own first, that has a licence file: one whose notices make up ``share`` of its words or that begins with
    the heading of a licence. Of several licence
    files of a directory the one with the smallest path counts. Directories, not files, are joined with their
    ancestors, so a directory with very many files adds one row to that join.

    A null path has no directory and inherits nothing. Repeated paths are judged row by row. Empty table: no rows.
    """
    found = stored(
        scanned(files.withColumn("_path", path)).withColumn("path", F.col("row._path"))
        .withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")).withColumn("row", F.col("row").dropFields("_path")), "scanned"
    )
    owners = found.where(F.col("license").isNotNull() & ((F.col("share") >= share) | F.col("titled")) & F.col("dir").isNotNull()).groupBy("dir").agg(
        F.min_by("license", F.struct("path", "license")).alias("above")
    ).select(F.col("dir").alias("directory"), "above")
    levels = F.split("dir", "/")
    ancestors = found.where("dir IS NOT NULL").select("dir").distinct().select(
        "dir", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(levels)), lambda n: F.array_join(F.slice(levels, 1, n), "/"))).alias("depth", "directory")
    )
    nearest = stored(
        ancestors.join(owners, "directory").groupBy("dir").agg(F.max(F.struct("depth", "directory", "above")).alias("best"))
        .select(F.col("dir").alias("_dir"), "best.directory", "best.above"), "nearest",
    )
    if nearest.count() <= ID_ROWS // 10:
        nearest = F.broadcast(nearest)
    own = F.col("license").isNotNull()
    return found.join(nearest, found["dir"] == F.col("_dir"), "left").select(
        "row", "path", "license", "cosine", "share", F.coalesce("license", "above").alias("effective"),
        F.when(~own, F.col("directory")).alias("directory"),
    )
