"""License scan: TF-IDF cosine of headers and license files to templates, then inheritance along directories.

Every line of every whole text is a possible statement, every window of consecutive lines
a possible header, title or license text, as long as its template. Their sparse TF-IDF
vectors (inverse document frequencies come from all lines of the corpus; a term's repeats
count by their logarithm in windows) are compared with the templates' by cosine. Only lines
with a template's heavy terms, and texts that hold enough of a template's weight, can
reach ``least``: what the other terms weigh is too little, so the rest is
passed over without loss. A file takes its best header's license. A file most of
whose words lie in license lines, or one with a license that is named as license files
are, is a license file of its directory; files
without a header of their own inherit from the nearest ancestor directory that
has one, by joins on the directories' paths.

Defined cases: a null or empty text has no license of its own; a null path has
no directory and inherits nothing; ties go to the first license name; of several
license files in a directory the one with the greater cosine counts, then the
first name. Repeated rows are scanned each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import broadcast_if_small, map_frames, materialise

LEAST = 0.6
FILE_SHARE = 0.5

#: Short statements of public licenses. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "All rights reserved.",
}
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free
Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope
that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the {0} for more details. You should have received a copy of the {0} along with this program."""

#: Whole texts, standard headers and titles of public licenses. Fixed values.
LONG = {
    "MIT": ("""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. """ + _WARRANTY + """ IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",),
    "ISC": ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",),
    "BSD-2-Clause": (f"{_BSD} {_BSD_END}",),
    "BSD-3-Clause": (f"""{_BSD} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission. {_BSD_END}""",),
    "Unlicense": ("""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law. """ + _WARRANTY + """ IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",),
    "Apache-2.0": ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You
may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the License.""",
                   "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    "GPL-2.0": (_GNU.format("GNU General Public License", "2"), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    "GPL-3.0": (_GNU.format("GNU General Public License", "3"), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    "LGPL-2.1": (_GNU.format("GNU Lesser General Public License", "2.1"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
    "LGPL-3.0": (_GNU.format("GNU Lesser General Public License", "3"), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    "AGPL-3.0": (_GNU.format("GNU Affero General Public License", "3"), "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    "MPL-2.0": ("""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""", "Mozilla Public License Version 2.0 Definitions Contributor means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    "CC0-1.0": ("CC0 1.0 Universal Statement of Purpose The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights",
                "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal Public Domain Dedication"),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "CC-BY-NC-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",),
}
#: Names of license files, without what follows a dot or a dash. Fixed values.
FILE_NAMES = ("license", "licence", "copying", "unlicense")
_TERM = re.compile(r"[a-z]+(?:-[a-z]+)*|[0-9]+(?:\.[0-9]+)*")
_PIECE = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")  # lines may be broken at hyphens


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def pieces(text: str) -> list[str]:
    return _PIECE.findall(text.lower())


VOCABULARY = sorted({t for s in TEMPLATES.values() for t in terms(s)} | {t for texts in LONG.values() for s in texts for t in pieces(s)})


def _frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    inside = frozenset(VOCABULARY)
    for f in frames:
        n, lines = Counter(), 0
        for text in f["text"]:
            for line in (text or "").lower().split("\n"):
                lines += 1
                n.update(inside.intersection(_TERM.findall(line) + (_PIECE.findall(line) if "-" in line else [])))
        yield pd.DataFrame([("", lines), *n.items()], columns=["term", "n"])


def frequencies(files: DataFrame) -> dict[str, float]:
    """Inverse document frequencies of the templates' terms over all lines; '' is that of an unseen term."""
    rows = files.select("text").transform(map_frames, _frequencies, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = {r["term"]: r["n"] for r in rows}  # as many as the templates have terms
    lines = n.get("", 0)
    return {t: float(np.log((1 + lines) / (1 + (0 if t == "" else n.get(t, 0)))) + 1) for t in ["", *VOCABULARY]}


class Matcher:
    """Cosines of lines with all templates."""

    def __init__(self, idf: dict[str, float], least: float = LEAST):
        self.idf, self.least = idf, least
        self.names = sorted(TEMPLATES)
        self.vectors = []
        heavy = set()
        for name in self.names:
            v = {t: n * idf[t] for t, n in Counter(terms(TEMPLATES[name])).items()}
            norm = sum(x * x for x in v.values()) ** 0.5
            v = {t: x / norm for t, x in v.items()}
            self.vectors.append(v)
            rest = 1.0
            for t, x in sorted(v.items(), key=lambda p: (-p[1], p[0])):
                if rest < least * least:  # the remaining terms alone can't reach it
                    break
                heavy.add(t)
                rest -= x * x
        self.long = []  # name, vector, terms of a window, terms of which a window must hold one
        for name in sorted(LONG):
            for text in LONG[name]:
                v, norm = self.weights(Counter(pieces(text)))
                v = {t: x / norm for t, x in v.items()}
                rest, needed = 1.0, set()
                for t, _ in sorted(v.items(), key=lambda p: (-idf[p[0]], p[0])):  # rare ones first: the others alone can't reach it
                    if rest < least * least:
                        break
                    needed.add(t)
                    rest -= v[t] ** 2
                self.long.append((name, v, len(pieces(text)), frozenset(needed)))
        self.any_long = frozenset().union(*(x[3] for x in self.long))
        self.any = re.compile("|".join(sorted(map(re.escape, heavy), key=lambda t: (-len(t), t))))

    def line(self, line: str) -> tuple[float, str] | None:
        if not self.any.search(line):
            return None
        v = {t: n * self.idf.get(t, self.idf[""]) for t, n in Counter(_TERM.findall(line)).items()}
        norm = sum(x * x for x in v.values()) ** 0.5 or 1.0
        best = max((sum(x * v.get(t, 0.0) for t, x in u.items()) / norm, -i) for i, u in enumerate(self.vectors))
        return (best[0], self.names[-best[1]]) if best[0] >= self.least else None

    def weights(self, counts: Counter) -> tuple[dict[str, float], float]:
        """A window's vector, repeats by their logarithm, and its length."""
        v = {t: (1 + log(n)) * self.idf.get(t, self.idf[""]) for t, n in counts.items() if n}
        return v, sum(x * x for x in v.values()) ** 0.5 or 1.0

    def windows(self, lines: list[str]) -> Iterator[tuple[float, str, int, int]]:
        """(cosine, name, first line, line after the last) of the windows that reach ``least``."""
        cut = [_PIECE.findall(line) for line in lines]
        held = set().union(*cut)
        if self.any_long.isdisjoint(held):
            return
        for name, u, size, needed in self.long:
            if needed.isdisjoint(held) or sum(x * x for t, x in u.items() if t in held) < self.least**2:
                continue
            end, n, counts = 0, 0, Counter()
            for begin, first in enumerate(cut):
                while end < len(cut) and n < size:
                    counts.update(cut[end])
                    n += len(cut[end])
                    end += 1
                if first:
                    v, norm = self.weights(counts)
                    cosine = sum(x * v.get(t, 0.0) for t, x in u.items()) / norm
                    if cosine >= self.least:
                        yield cosine, name, begin, end
                    counts.subtract(first)
                    counts += Counter()  # without those that are gone
                    n -= len(first)

    def text(self, text: str) -> tuple[tuple[float, str] | None, float]:
        """The best (cosine, license) of a lower-case text, and the share of its words in license lines."""
        lines, best, inside = text.split("\n"), None, set()
        found = [(*x, i, i + 1) for i, line in enumerate(lines) if (x := self.line(line))] if self.any.search(text) else []
        for cosine, name, begin, end in (*found, *self.windows(lines)):
            inside.update(range(begin, end))
            best = max(best or (cosine, name), (cosine, name), key=lambda x: (x[0], [-ord(c) for c in x[1]]))
        return best, sum(len(lines[i].split()) for i in inside) / max(1, len(text.split())) if best else 0.0


def own_licenses(files: DataFrame, idf: dict[str, float], least: float = LEAST) -> DataFrame:
    """(doc_id, path, license, cosine, share): share is that of words in license lines."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(idf, least)
        for f in frames:
            rows = []
            for text in f["text"]:
                best, share = matcher.text((text or "").lower())
                rows.append((*(best[::-1] if best else (None, None)), share))
            out = pd.DataFrame(rows, columns=["license", "cosine", "share"])
            out["cosine"] = out["cosine"].astype("Float64")
            yield pd.concat([pd.DataFrame({"doc_id": f["doc_id"].astype("Int64").array, "path": f["path"].array}), out], axis=1)

    return files.select(F.col("doc_id").cast("long").alias("doc_id"), "path", "text").transform(map_frames, 
        work, "doc_id long, path string, license string, cosine double, share double")


def scan(files: DataFrame, least: float = LEAST, file_share: float = FILE_SHARE) -> DataFrame:
    """(doc_id, path, license, cosine, inherited_from) of files (doc_id, path, text).

    license is null if there is none; inherited_from is the directory it comes from.
    """
    own = materialise(own_licenses(files, frequencies(files), least), "own-licenses")
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    # one license for each directory
    first = F.max_by(F.struct("license", "cosine"), F.struct(F.col("cosine"), F.transform(F.split("license", ""), lambda c: -F.ascii(c))))
    named = F.regexp_extract(F.lower("path"), "([^/.-]*)[^/]*$", 1).isin(*FILE_NAMES) & F.col("license").isNotNull()
    granted = (own.where(((F.col("share") >= file_share) | named) & F.col("path").isNotNull()).groupBy(folder.alias("dir"))
               .agg(first.alias("given")))
    granted = materialise(granted.select("dir", F.col("given.license").alias("given")), "license-files")
    # directories of files without a license: each once, with all its ancestors (as many as it is deep)
    needy = own.where(F.col("license").isNull() & F.col("path").isNotNull()).select(folder.alias("of")).distinct()
    parts = F.split("of", "/")
    up = needy.select("of", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).alias("dir"))
    near = (up.join(broadcast_if_small(granted, granted.count(), 200), "dir").groupBy("of")
            .agg(F.max_by(F.struct("given", "dir"), F.length("dir")).alias("near")))
    near = materialise(near, "nearest-licenses")  # a row for a directory: few next to the files
    joined = own.withColumn("of", folder).join(broadcast_if_small(near, near.count(), 200), "of", "left")
    return joined.select("doc_id", "path", F.coalesce("license", "near.given").alias("license"), "cosine",
                         F.when(F.col("license").isNull(), F.col("near.dir")).alias("inherited_from"))
