"""License scans by conditional compression.

Around every mention of licensing, a window that any block of a template's length can lie in is
aligned with the template word by word, whatever its lines and paragraphs; words before and after
the block are free. Each block found is compressed alone and with its template as a zstandard raw
dictionary. Of blocks that overlap, the one that its template shrinks by most bytes stays, and is
reported with exactly the words it lacks and adds. Words that identify a license must all be there,
and none that makes another license of it may be added.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import ship_package, text_of

_WORD = re.compile(r"\w(?:[\w.+-]*[\w+])?")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


# The wording of common notices, by SPDX identifier; the words that identify the
# license, of which none may be missing or replaced; and what may not follow the notice (a regular
# expression over the next words), because it makes it another license's.
_OR_LATER = r"or (any |\(?at your option\)? ?)*(later|newer|above|greater|higher)|or at your option|and (any )?later"
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License",
        "AGPL": "GNU Affero General Public License"}
_GNU_VERSIONS = (("GPL", "2"), ("GPL", "3"), ("LGPL", "2.1"), ("LGPL", "3"), ("AGPL", "3"))
_CC = {"": "Attribution", "-NC": "Attribution-NonCommercial", "-SA": "Attribution-ShareAlike",
       "-ND": "Attribution-NoDerivatives", "-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_BSD_INTRO = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
              "provided that the following conditions are met:")
_BSD_2 = (_BSD_INTRO + " Redistributions of source code must retain the above copyright notice, this list of "
          "conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
          "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
          "materials provided with the distribution.")
_BSD_ADS = (" All advertising materials mentioning features or use of this software must display the following "
            "acknowledgement: This product includes software developed by the organization.")
_BSD_NAMES = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so")
_X11 = (", subject to the following conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE X CONSORTIUM BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. Except as contained in this notice, the name of "
        "the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in "
        "this Software without prior written authorization from the X Consortium.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted")


def _gnu(kind: str, version: str) -> Iterator[tuple]:
    name, spdx = _GNU[kind], f"{kind}-{version if '.' in version else version + '.0'}"
    versions = [version] if "." in version else [version, version + ".0"]
    adjective = name.split()[1]
    start = "This program is free software: you can redistribute it and/or modify it under the terms of the "
    full = start + f"{name} as published by the Free Software Foundation, "
    yield (f"{spdx}-or-later", f"{full}either version {version} of the License, or (at your option) any later "
           "version.", f"GNU {adjective} {version} or later")
    yield f"{spdx}-only", f"{full}version {version} of the License.", f"GNU {adjective} {version}", _OR_LATER
    yield (f"{spdx}-only", f"{start}{name} version {version} as published by the Free Software Foundation.",
           f"GNU {adjective} {version}", _OR_LATER)
    for v in versions:
        for text in (f"This work is licensed under the {name}, version {v}", f"Licensed under the {name} v{v}"):
            said = words_of(text)[-1]
            yield f"{spdx}-only", text + ".", f"GNU {adjective} {said}", _OR_LATER
            for later in ("or later", "or any later version", "or (at your option) any later version"):
                yield f"{spdx}-or-later", f"{text} {later}.", f"GNU {adjective} {said} or later"
    short = f"{kind}v{version}"
    for the in ("", "the "):
        yield f"{spdx}-only", f"Licensed under {the}{short}.", short, _OR_LATER
        yield f"{spdx}-or-later", f"Licensed under {the}{short}+.", short + "+"
        yield f"{spdx}-or-later", f"Licensed under {the}{short} or later.", f"{short} or later"


def _creative_commons(kind: str) -> Iterator[tuple]:
    for version, port in (("4.0", "International"), ("3.0", "Unported"), ("2.0", "Generic")):
        spdx, short = f"CC-BY{kind}-{version}", f"CC BY{kind} {version}"
        for said in {short: 0, f"CC-BY{kind} {version}": 0, short.replace("-", " "): 0, spdx: 0}:
            yield spdx, f"Licensed under {said}.", said
        for said in {_CC[kind]: 0, _CC[kind].replace("-", " "): 0, _CC[kind].replace("Derivatives", "Derivs"): 0}:
            yield (spdx, f"This work is licensed under a Creative Commons {said} {version} {port} License.",
                   f"Creative Commons {said} {version}")


# the words that name a template's license come after its text; texts of one license alone need none
def _templates() -> Iterator[tuple]:
    yield "MIT", "Released under the MIT License.", "MIT"
    yield ("MIT", _MIT + ", subject to the following conditions:", "granted free charge deal restriction subject conditions",
           r"the above copyright .* except as contained in this notice")
    yield "MIT-0", _MIT + ".", "granted free charge deal restriction", r"subject"
    yield "X11", _MIT + _X11, "granted free charge deal restriction subject conditions except advertising"
    yield "MIT", "This project is licensed under the MIT License.", "MIT"
    apache = "Apache 2.0"
    yield "Apache-2.0", "Licensed under the Apache License, Version 2.0.", apache
    yield ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
           "except in compliance with the License.", apache)
    yield "Apache-2.0", "Released under the Apache License 2.0.", apache
    yield "Apache-2.0", "Licensed under the Apache 2.0 License.", apache
    for version in ("1.0", "1.1"):
        yield f"Apache-{version}", f"Licensed under the Apache License, Version {version}.", f"Apache {version}"
    for kind, version in _GNU_VERSIONS:
        yield from _gnu(kind, version)
    yield ("LGPL-2.0-or-later", "This library is free software; you can redistribute it and/or modify it under the "
           "terms of the GNU Library General Public License as published by the Free Software Foundation; either "
           "version 2 of the License, or (at your option) any later version.", "GNU Library General 2 or later")
    for kind in _CC:
        yield from _creative_commons(kind)
    yield "CC0-1.0", "Licensed under CC0 1.0.", "CC0 1.0"
    yield "CC0-1.0", "Licensed under the Creative Commons CC0 1.0 Universal license.", "CC0 1.0"
    yield "BSD", _BSD_INTRO, "redistribution source binary"  # which BSD license, only the conditions tell
    yield "BSD-2-Clause", _BSD_2, "redistribution redistributions source binary", \
        r"(\S+ ){0,3}(neither the name|the names? of|the end-user|all advertising)"
    yield "BSD-3-Clause", _BSD_2 + _BSD_NAMES, "redistribution redistributions neither names endorse promote"
    yield ("BSD-4-Clause", _BSD_2 + _BSD_ADS + _BSD_NAMES,
           "redistribution redistributions advertising acknowledgement neither names endorse promote")
    yield "BSD", "Released under the BSD License.", "BSD"
    yield "BSD", "Licensed under a BSD-style license.", "BSD-style"
    for spdx, names in (("BSD-2-Clause", ("2-clause", "simplified")), ("BSD-3-Clause", ("3-clause", "new", "revised",
                        "modified")), ("BSD-4-Clause", ("4-clause", "original"))):
        for name in names:
            yield spdx, f"Released under the {name} BSD License.", f"BSD {name}"
        yield spdx, f"Licensed under the BSD {names[0]} License.", f"BSD {names[0]}"
        yield spdx, f"Licensed under the {spdx} license.", spdx
    yield ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
           "Mozilla 2.0")
    yield "MPL-2.0", "Licensed under the Mozilla Public License, version 2.0.", "Mozilla 2.0"
    yield "MPL-1.1", "Licensed under the Mozilla Public License, version 1.1.", "Mozilla 1.1"
    yield ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
           "Public License 2.0.", "Eclipse 2.0")
    yield ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
           "Public License v1.0.", "Eclipse v1.0")
    yield "ISC", "Released under the ISC License.", "ISC"
    yield ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies.",
           "permission granted provided appear")
    yield "0BSD", _ISC + ".", "permission granted", r"provided"
    yield ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial "
           "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
           "anyone alter freely restrictions")
    yield ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.", "Boost 1.0")
    yield ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered public domain")
    yield ("Artistic-2.0", "Licensed under the Artistic License 2.0.", "Artistic 2.0")
    yield "all-rights-reserved", "All rights reserved.", "rights reserved"


#: SPDX identifiers that a tag may name, with those that SPDX has renamed since.
SPDX = {s.lower(): s for s in """0BSD AFL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-1-Clause
    BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC0-1.0 CDDL-1.0
    CDDL-1.1 CECILL-2.1 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 ISC LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0
    MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 Ruby
    SSPL-1.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1""".split()}
SPDX |= {f"cc-by{k}-{v}".lower(): f"CC-BY{k}-{v}" for k in _CC for v in ("1.0", "2.0", "2.5", "3.0", "4.0")}
for _name in ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-1.0", "AGPL-3.0"):
    for _end, _now in (("", "-only"), ("-only", "-only"), ("+", "-or-later"), ("-or-later", "-or-later")):
        SPDX[(_name + _end).lower()] = _name + _now
#: Words that make another license of a notice they are added to.
QUALIFIERS = frozenset("""nc sa nd noncommercial non-commercial sharealike share-alike noderivatives noderivs
    no-derivatives lesser library affero lgpl agpl 0-clause 1-clause 2-clause 3-clause 4-clause clear patent mit-0 0bsd""".split())
TEMPLATES = tuple(_templates())
#: Blocks that mention none of these are no notice (a notice may be wrapped at any space).
CUE = (r"(?i)licen[cs]|copyright|rights\W+reserved|redistribut|permission\W+(?:is|to)\b|creative\W+commons"
       r"|\bcc[ -]?(?:by|0)|\b[al]?gplv|\bunencumbered")
#: Confirmed if at least this share of the template's words is there in order, and at most so
#: many other words, relative to the template, are added.
MIN_FOUND, MAX_ADDED = 0.85, 0.25
#: A word at a block's edge that is spelled this much like the missing word next to it replaces it.
ALIKE = 0.7
#: Words of one alignment at least, in blocks of a template's length; a longer stretch is cut into
#: windows that overlap by a block.
WINDOW_WORDS, WINDOW_BLOCKS = 400, 6

_TAG = re.compile(r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]*)")
_EXPRESSION_WORD = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*")
_NEVER = 1 << 20  # the cost of a difference that rules a block out


class Template:
    def __init__(self, name: str, text: str, must: str, not_after: str, vocabulary: dict[str, int], fmt):
        self.name, self.words, self.must = name, words_of(text), set(words_of(must))
        n = len(self.words)
        if not self.must <= set(self.words):
            raise ValueError(f"identifying words that the template lacks: {must!r}, {text!r}")
        self.not_after = re.compile(not_after) if not_after else None
        self.ids = [vocabulary.setdefault(w, len(vocabulary)) for w in self.words]
        self.distinct = set(self.words)
        self.miss_cost = [_NEVER if w in self.must else 1 for w in self.words]
        self.may_lack = max(1 if n >= 5 else 0, int((1 - MIN_FOUND) * n + 1e-9))  # one word of a short notice
        self.may_add = int(MAX_ADDED * n + 1e-9)
        self.reach = n + self.may_add + 1
        raw = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(compression_params=fmt, dict_data=raw)

    def dense(self, ids: np.ndarray, known: np.ndarray) -> bool:
        """Does any stretch of a block's length hold enough words of the template at all?"""
        total = np.concatenate(([0], np.cumsum(known[ids])))
        far = min(self.reach, len(ids))
        return int((total[far:] - total[:-far]).max()) >= len(self.words) - self.may_lack

    def align(self, ids: np.ndarray, add_cost: np.ndarray) -> tuple[int, int, list[int]] | None:
        """First and last word matched, and for each template word its place or -1, with the fewest
        words missing and added; words before and after are free."""
        m = len(ids)
        added = np.concatenate(([0], np.cumsum(add_cost)))
        cost = np.zeros((len(self.ids) + 1, m + 1), np.int64)
        for i, want in enumerate(self.ids):
            row = cost[i] + self.miss_cost[i]
            row[1:] = np.minimum(row[1:], np.where(ids == want, cost[i, :-1], _NEVER * 1024))
            cost[i + 1] = np.minimum.accumulate(row - added) + added
        j = int(cost[-1].argmin())
        if cost[-1, j] >= _NEVER:
            return None
        places, i = [-1] * len(self.ids), len(self.ids)
        while i:
            if j and ids[j - 1] == self.ids[i - 1] and cost[i, j] == cost[i - 1, j - 1]:
                i, j = i - 1, j - 1
                places[i] = j
            elif cost[i, j] == cost[i - 1, j] + self.miss_cost[i - 1]:
                i -= 1
            else:
                j -= 1
        at = [k for k in places if k >= 0]
        return (at[0], at[-1], places) if at else None


class Scanner:
    def __init__(self, templates=TEMPLATES, cue: str = CUE):
        self.cue = re.compile(cue)
        bare = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        fmt = zstandard.ZstdCompressionParameters.from_level(19, format=zstandard.FORMAT_ZSTD1_MAGICLESS, **bare)
        self.fmt = fmt
        self.alone = zstandard.ZstdCompressor(compression_params=fmt)
        self.vocabulary: dict[str, int] = {}
        # (name, text), (name, text, identifying words) or (name, text, identifying words, not after)
        self.templates = [Template(*t, *("",) * (4 - len(t)), self.vocabulary, fmt) for t in templates]
        self.known = []
        for t in self.templates:
            known = np.zeros(len(self.vocabulary) + 1, np.int64)  # the last place is for unknown words
            known[t.ids] = 1
            self.known.append(known)

    def scan(self, text: str) -> list[dict]:
        """Notices of a text: first and last line (from 0), license, words missing and added. Blocks
        reported do not overlap; of equal lines and license the one that differs least is reported."""
        cues = [m.start() for m in self.cue.finditer(text)]
        if not cues:
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        starts = [a for a, _ in spans]
        cued = sorted({max(0, bisect.bisect_right(starts, at) - 1) for at in cues})
        ids = np.array([self.vocabulary.get(w, -1) for w in words], np.int64)
        add_cost = np.array([_NEVER if w in QUALIFIERS else 1 for w in words], np.int64)
        present, found = set(words), []
        for k, t in enumerate(self.templates):
            if not t.must <= present or len(t.distinct - present) > t.may_lack:
                continue
            for lo, hi in _windows(cued, t.reach, len(words)):
                if t.dense(ids[lo:hi], self.known[k]):
                    found += [(k, *hit) for hit in self._blocks(t, words, ids, add_cost, lo, hi)]
        return self._tags(text) + self._report(text, spans, found)

    def _tags(self, text: str) -> list[dict]:
        """The licenses that SPDX tags name: a row for each of an expression."""
        out = {}
        for tag in _TAG.finditer(text):
            line, data = text.count("\n", 0, tag.start()), " ".join(tag.group().lower().split()).encode()
            for name in _EXPRESSION_WORD.findall(re.sub(r"(?i)\bWITH\s+\S+", " ", tag.group(1))):
                if spdx := SPDX.get(name.lower()):
                    raw = zstandard.ZstdCompressionDict(f"spdx-license-identifier: {name.lower()}".encode(),
                                                        dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                    given = zstandard.ZstdCompressor(compression_params=self.fmt, dict_data=raw).compress(data)
                    out[line, spdx] = {"first_line": line, "last_line": line, "license": spdx, "missing": [], "added": [],
                                       "shrinkage": 1 - len(given) / len(self.alone.compress(data))}
        return list(out.values())

    def _blocks(self, t: Template, words, ids, add_cost, lo: int, hi: int) -> list[tuple]:
        """(first word, end, missing, added) of each confirmed block of a window."""
        out, todo = [], [(lo, hi)]
        while todo:
            lo, hi = todo.pop()
            if hi - lo < len(t.words) - t.may_lack or (hit := t.align(ids[lo:hi], add_cost[lo:hi])) is None:
                continue
            first, last, places = lo + hit[0], lo + hit[1], hit[2]
            todo += [(lo, first), (last + 1, hi)]
            matched = {lo + p for p in places if p >= 0}
            head = next(k for k, p in enumerate(places) if p >= 0)
            tail = next(k for k in range(len(places), 0, -1) if places[k - 1] >= 0)
            while head and first and _alike(t.words[head - 1], words[first - 1]):
                head, first = head - 1, first - 1
            while tail < len(places) and last + 1 < len(words) and _alike(t.words[tail], words[last + 1]):
                tail, last = tail + 1, last + 1
            missing = [w for w, p in zip(t.words, places, strict=True) if p < 0]
            added = [words[k] for k in range(first, last + 1) if k not in matched]
            if t.not_after and t.not_after.match(" ".join(words[last + 1:last + 150])):
                continue
            if len(missing) <= t.may_lack and len(added) <= t.may_add:
                out.append((first, last + 1, missing, added))
        return out

    def _report(self, text: str, spans: list[tuple[int, int]], found: list[tuple]) -> list[dict]:
        rated = []
        for k, first, end, missing, added in found:
            t = self.templates[k]
            data = " ".join(text[spans[first][0]:spans[end - 1][1]].lower().split()).encode()
            plain, given = len(self.alone.compress(data)), len(t.compressor.compress(data))
            explained = len(t.words) - 2 * len(missing) - len(added)
            rated.append((plain - given, explained, -k, first, end, 1 - given / plain, missing, added))
        rated.sort(key=lambda x: x[:5], reverse=True)
        taken, chosen = [], []  # taken: ends of the chosen blocks, sorted by their first word
        for one in rated:
            first, end = one[3:5]
            at = bisect.bisect_right(taken, (first, end))
            if (at and taken[at - 1][1] > first) or (at < len(taken) and taken[at][0] < end):
                continue
            taken.insert(at, (first, end))
            chosen.append(one)
        # several templates of the license chosen may explain the same words: the closest is reported
        by_block, at_of = {(c[3], c[4]): c for c in chosen}, sorted((c[3], c[4]) for c in chosen)
        for one in rated:
            at = bisect.bisect_right(at_of, (one[4], -1)) - 1
            if at < 0 or at_of[at][1] <= one[3]:
                continue
            now = by_block[at_of[at]]
            inside = at_of[at][0] <= one[3] and one[4] <= at_of[at][1]
            if inside and self.templates[-one[2]].name == self.templates[-now[2]].name and one[1] > now[1]:
                by_block[at_of[at]] = one
        lines = [m.start() for m in re.finditer("\n", text)]
        out = {}
        for _, _, k, first, end, shrinkage, missing, added in sorted(by_block.values(), key=lambda x: x[3]):
            name = self.templates[-k].name
            now = {"first_line": bisect.bisect_left(lines, spans[first][0]),
                   "last_line": bisect.bisect_left(lines, spans[end - 1][0]), "license": name,
                   "shrinkage": shrinkage, "missing": missing, "added": added}
            old = out.setdefault((now["first_line"], now["last_line"], name), now)
            if len(missing) + len(added) < len(old["missing"]) + len(old["added"]):
                out[now["first_line"], now["last_line"], name] = now
        return list(out.values())


def _alike(want: str, have: str) -> bool:
    return difflib.SequenceMatcher(None, want, have, autojunk=False).ratio() >= ALIKE


def _windows(cued: list[int], reach: int, n_words: int) -> Iterator[tuple[int, int]]:
    """Stretches of words that hold every block of up to ``reach`` words with a cue in it."""
    size = max(WINDOW_WORDS, WINDOW_BLOCKS * reach)

    def cut(lo: int, hi: int) -> Iterator[tuple[int, int]]:
        while hi - lo > size:
            yield lo, lo + size
            lo += size - reach
        yield lo, hi

    lo = hi = None
    for at in cued:
        if hi is not None and at - reach > hi:
            yield from cut(lo, hi)
            lo = None
        if lo is None:
            lo = max(0, at - reach)
        hi = min(n_words, at + reach + 1)
    if lo is not None:
        yield from cut(lo, hi)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, cue: str = CUE) -> DataFrame:
    """A row per notice: doc_id, first_line, last_line, license, shrinkage, missing, added.

    Null and empty texts hold none; repeated rows report their notices again; other columns are
    not read. Only texts that match ``cue`` leave the JVM.
    """
    ship_package(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, first_line long, last_line long, license string, shrinkage double, "
              "missing array<string>, added array<string>")
    names = ("first_line", "last_line", "license", "shrinkage", "missing", "added")
    types = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, cue)
        for batch in batches:
            at, hits = [], []
            for k, text in enumerate(batch.column(1)):
                found = scanner.scan(text.as_py())
                at += [k] * len(found)
                hits += found
            cols = {"doc_id": batch.column(0).take(pa.array(at, pa.int64()))}
            cols |= {n: pa.array([h[n] for h in hits], t) for n, t in zip(names, types, strict=True)}
            yield pa.RecordBatch.from_pydict(cols)

    return (docs.select("doc_id", text_of().alias("text")).filter(F.col("text").rlike(cue))
            .mapInArrow(run, schema))
