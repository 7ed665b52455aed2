"""License scan by conditional compression.

A text is read as one run of words, so that line breaks, comment marks and sentence ends do not cut a notice.
Every telling word is laid on each telling word of each template; where the words around it nearly agree,
the stretch is a candidate. It is compressed by zstandard on its own and with its template as a raw dictionary,
and confirmed by the exact wording differences. Of overlapping notices the one with more words in place stays.
SPDX tags are read as they stand, whatever identifier they hold.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.llm.common import fresh_name, with_row_id

#: Short notices by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
}
#: Further forms: standard headers and bodies. GPL-family headers say "or later", which is another identifier.
FORMS = {
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: '
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
        "This project is licensed under the MIT License",
    ),
    "GPL-3.0-or-later": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "GPL-2.0-or-later": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "BSD-3-Clause": ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.",),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.",),
}
#: A stretch is a candidate if it has one of these, in any case.
TELLING = re.compile(r"licen[sc]|copyright|public domain|spdx", re.I)
_TELLING_BYTES = re.compile(TELLING.pattern.encode(), re.I)
_WORD = re.compile(r"[^\W_]+")
_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*(\(?[A-Za-z0-9][A-Za-z0-9.+\-]*\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9][A-Za-z0-9.+\-]*\)*)*)")
#: Words of a template that give it one more time ``max_changes``.
CHANGE_WORDS = 20
FINDINGS = "license string, begin long, end long, saved double, removed array<string>, added array<string>"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def all_forms() -> dict[str, tuple[str, ...]]:
    """Every form by SPDX identifier."""
    return {k: (*((TEMPLATES[k],) if k in TEMPLATES else ()), *FORMS.get(k, ())) for k in {**TEMPLATES, **FORMS}}


class Template:
    """A form's words, where the telling ones are, which name the license, and its compressor."""

    def __init__(self, license: str, text: str, max_changes: int, plain):
        self.license, self.words, self.count = license, words(text), Counter(words(text))
        self.tells = telling(text, [m.span() for m in _WORD.finditer(text)])
        self.allowed = max_changes * max(1, len(self.words) // CHANGE_WORDS)
        # a number, or a capital inside a sentence, is a name's: putting another in its place is two changes
        self.names = set()
        for m in _WORD.finditer(text):
            inside = not re.search(r"(^|[.!?:]\s+)$", text[: m.start()])
            if re.search(r"\d", m[0]) or (inside and m[0].lower() != m[0] and m[0].lower() != "version" and not TELLING.search(m[0])):
                self.names.add(m[0].lower())
        data = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.given = zstandard.ZstdCompressor(compression_params=plain, dict_data=data)

    def match(self, own: list[str]) -> tuple | None:
        """(first word, end, changes, removed, added) of the form in a stretch with words to spare at both ends."""
        if sum((self.count - Counter(own)).values()) > self.allowed:
            return None
        codes = SequenceMatcher(None, self.words, own, autojunk=False).get_opcodes()
        first, end, changes, removed, added = 0, len(own), 0, [], []
        for at, (tag, i, j, k, m) in enumerate(codes):
            if tag == "equal":
                continue
            # words beyond the form's ends are not its own; one that stands for a missing word there is
            if at == 0 and m - k > j - i:
                k = first = m - (j - i)
            if at == len(codes) - 1 and m - k > j - i:
                m = end = k + (j - i)
            lost, new = self.words[i:j], own[k:m]
            named = any(w in self.names or w.isdigit() for w in lost) or any(w.isdigit() for w in new)
            changes += len(lost) + len(new) if named else max(len(lost), len(new))
            removed += lost
            added += new
        return (first, end, changes, removed, added) if changes <= self.allowed else None


class Scanner:
    """All forms of the templates, each with a compressor that has it as raw dictionary."""

    def __init__(self, templates: dict, max_changes: int):
        plain = zstandard.ZstdCompressionParameters(compression_level=3, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.alone = zstandard.ZstdCompressor(compression_params=plain)
        forms = ((k, t) for k, ts in templates.items() for t in ((ts,) if isinstance(ts, str) else ts))
        self.templates = [Template(k, t, max_changes, plain) for k, t in forms]

    def scan(self, content: bytes) -> list[tuple]:
        """(license, begin, end, saved, removed, added) in order of place."""
        if not _TELLING_BYTES.search(content):
            return []
        text = content.decode("utf-8", "surrogateescape")
        bytes_of = lambda a, b: text[a:b].encode("utf-8", "surrogateescape")
        spans = [m.span() for m in _WORD.finditer(text)]
        own = [text[a:b].lower() for a, b in spans]
        found, seen = {}, {}
        for hit in telling(text, spans):
            for n, t in enumerate(self.templates):
                for at in t.tells:
                    i, j = max(0, hit - at - t.allowed), min(len(own), hit - at + len(t.words) + t.allowed)
                    stretch = tuple(own[i:j])
                    if (n, stretch) not in seen:
                        seen[n, stretch] = t.match(list(stretch))
                    if m := seen[n, stretch]:
                        a, b = spans[i + m[0]][0], spans[i + m[1] - 1][1]
                        while text[b : b + 1] in (".", "!", "?"):
                            b += 1
                        block = bytes_of(a, b)
                        saved = 1 - len(t.given.compress(block)) / len(self.alone.compress(block))
                        # words in place less words changed, then savings
                        found[a, b, n] = ((m[2] + len(m[3]) - len(t.words), m[2], -saved, t.license), (t.license, a, b, saved, m[3], m[4]))
        tags = [(m[1].strip(), *m.span(), None, [], []) for m in _TAG.finditer(text)]
        kept = tags[:]
        for _, f in sorted(found.values(), key=lambda x: x[0]):
            if all(f[2] <= k[1] or f[1] >= k[2] for k in kept):
                kept.append(f)
        kept.sort(key=lambda f: f[1])
        out, last, size = [], 0, 0
        for k, a, b, *rest in kept:
            begin = size + len(bytes_of(last, a))
            last, size = b, begin + len(bytes_of(a, b))
            out.append((k, begin, size, *rest))
        return out


def telling(text: str, spans: list[tuple[int, int]]) -> list[int]:
    """Indexes of the words in which telling ones begin."""
    ends = [b for _, b in spans]
    return sorted({bisect_right(ends, m.start()) for m in TELLING.finditer(text)})


def license_scan(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] | None = None, id_col: str = "doc_id", text_col: str = "text", max_changes: int = 1) -> DataFrame:
    """One row per license notice in whole texts: (row_id, doc_id, license, begin, end, saved, removed, added).

    begin and end are byte offsets; saved is the share of the compressed size that the template saves (null
    for an SPDX tag, whose license is its expression); removed and added are the exact wording differences: at
    most ``max_changes``, or as many for every ``CHANGE_WORDS`` words of a longer template. A word in place of another is one
    change, or two if the template's word is a number or part of a name or the new one is a number, so another
    version or license is not taken for the template. A notice that occurs several times is several rows; notices do
    not overlap. Null and empty texts have none; an empty table gives no rows; other columns are not read.
    """
    templates = all_forms() if templates is None else templates
    row = fresh_name(docs, "_row")
    docs = with_row_id(docs, row).select(F.col(row).alias("row_id"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([*docs.select("row_id", "doc_id").schema, *T.StructType.fromDDL(FINDINGS)])

    def run(batches):
        scanner = Scanner(templates, max_changes)
        for b in batches:
            found = [(i, *f) for i, t in enumerate(b.column("text").cast(pa.large_binary())) for f in scanner.scan(t.as_py() or b"")]
            at = pa.array([f[0] for f in found], pa.int64())
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column("row_id").take(at), b.column("doc_id").take(at), *[pa.array([f[i + 1] for f in found], k) for i, k in enumerate(kinds)]], schema.names)

    return docs.mapInArrow(run, schema)
