"""License scans: winnowed fingerprints pick candidates, banded alignment confirms them.

Texts and templates become lower-case runs of letters and digits. Of the hashes of every ``GRAM``
consecutive tokens, the least of each ``WINNOW`` is a fingerprint. The inverted index of the templates' fingerprints is
fixed in size, as it grows with the templates alone, and is sent to every task. A shared fingerprint
fixes a diagonal; fingerprints of one template on near diagonals make a candidate, which is aligned with the template inside a band
around it, and again with what its matches leave free there, so that places next to each other each count. A match reports how
much of the template was found and from where to where in the text. Of whole licenses the winnowed fingerprints are listed; a notice is
so short that its neighbours in a text would decide which of its fingerprints are taken, so all its hashes are listed. Where one license
holds most of another, each is reported with its own coverage.

Null and empty texts have no matches. Rows with a null id and repeated rows are scanned each for itself.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strataflux.llm.common import bounded_batches, windows_of, word_hashes

GRAM, WINNOW, BAND = 3, 3, 12
#: Tokens from which a template is listed by its winnowed fingerprints only.
LONG = 64
#: Share of a template's tokens that must be found.
LEAST = 0.8
_token = re.compile(r"[a-z0-9]+").finditer
_tokens = re.compile(rb"[a-z0-9]+").findall

#: Notices as they stand in files, from the licenses' own texts.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
    "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: Whole licenses, without their titles and copyright lines. Fixed values.
LICENSES = {
    "MIT-license": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT '
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC-license": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY '
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause-license": _BSD_START + _BSD_END,
    "BSD-3-Clause-license": (
        _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_END
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
        'present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}


_FOLD = {c: c + 32 for c in range(65, 91)}


def tokens(text: str) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Tokens and their places. Only A-Z are folded, so that places stay those of the text."""
    found = list(_token(text.translate(_FOLD)))
    return [m.group().encode() for m in found], [m.span() for m in found]


def fingerprints(grams: np.ndarray) -> np.ndarray:
    """Positions of the winnowed hashes: the least of each window, the last on ties."""
    if len(grams) <= WINNOW:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))]) if len(grams) else np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, WINNOW)[:, ::-1]
    return np.unique(np.arange(len(view)) + WINNOW - 1 - view.argmin(1))


def align(template: np.ndarray, text: np.ndarray, diagonal: int, since: int, until: int, band: int = BAND) -> tuple[int, int, int]:
    """Tokens of the template found in order near a diagonal (text position minus template position) in text[since:until], and the first and last of them in the text.

    Longest common subsequence inside the band; of equal ones the tightest from its end.
    """
    width = 2 * band + 1
    best = np.zeros((len(template) + 1, width + 1), np.int32)  # cell (i, b): text position diagonal - band + i + b - 1
    equal = np.zeros((len(template) + 1, width + 1), bool)
    for i in range(1, len(template) + 1):
        at = diagonal - band + i - 1 + np.arange(width)
        ok = (at >= since) & (at < until)
        same = np.zeros(width, bool)
        same[ok] = text[at[ok]] == template[i - 1]
        equal[i, :width] = same
        row = np.maximum(best[i - 1, :width] + same, best[i - 1, 1:])
        best[i, :width] = np.maximum.accumulate(row)
    i, b = len(template), width - 1
    while b > 0 and best[i, b - 1] == best[i, b]:
        b -= 1
    ends: list[int] = []
    while i > 0 and best[i, b] > 0:
        if equal[i, b]:
            ends.append(diagonal - band + i - 1 + b)
            i -= 1
        elif b + 1 < width and best[i - 1, b + 1] == best[i, b]:
            i, b = i - 1, b + 1
        else:
            b -= 1
    return (len(ends), ends[-1], ends[0]) if ends else (0, -1, -1)


def places(template: np.ndarray, text: np.ndarray, diagonals: list[int], least: float) -> list[tuple[int, int, int]]:
    """Matches of a template, as :func:`align` gives them, that hold ``least`` of it and share no text."""
    out: list[tuple[int, int, int]] = []
    free = [(0, len(text))]
    for d in diagonals:
        todo, free = free, []
        while todo:
            since, until = todo.pop()
            # Only text in the band around the diagonal can match.
            if min(until, d + BAND + len(template)) - max(since, d - BAND) < least * len(template):
                free.append((since, until))
                continue
            n, first, end = align(template, text, d, since, until)
            if n < least * len(template):
                free.append((since, until))
                continue
            out.append((n, first, end))
            todo += [(since, first), (end + 1, until)]
    return sorted(out, key=lambda x: x[1])


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES | LICENSES, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, template, coverage, start, end, text): each place of a text that holds ``least`` of a template; start and end count code points."""
    names = sorted(templates)
    bodies = [word_hashes(tokens(templates[n])[0]) for n in names]
    index: defaultdict[int, list[tuple[int, int]]] = defaultdict(list)
    for t, body in enumerate(bodies):
        grams = windows_of(body, GRAM)
        for p in fingerprints(grams).tolist() if len(body) >= LONG else range(len(grams)):
            index[int(grams[p])].append((t, p))
    listed = np.array(sorted(index), np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast((names, bodies, dict(index), listed))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, bodies, index, listed = shared.value
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.iloc[lo : lo + 256]
                words, sizes = [], []
                for text in part["text"]:
                    own = _tokens(text.encode("utf-8", "surrogatepass").lower()) if text else []
                    words += own
                    sizes.append(len(own))
                h, ends = word_hashes(words), np.cumsum(sizes)
                rows = []
                for i, text, body in zip(part["id"].array, part["text"], np.split(h, ends[:-1])):
                    if len(body) < GRAM:
                        continue
                    grams = windows_of(body, GRAM)
                    known = np.flatnonzero(np.isin(grams, listed))
                    if not len(known):
                        continue
                    known = np.intersect1d(known, fingerprints(grams))
                    hits = defaultdict(set)
                    for p in known.tolist():
                        for t, q in index[int(grams[p])]:
                            hits[t].add(p - q)
                    spans = tokens(text)[1]
                    for t, diagonals in hits.items():
                        for n, first, end in places(bodies[t], body, sorted(diagonals), least):
                            rows.append((i, names[t], n / len(bodies[t]), spans[first][0], spans[end][1], text[spans[first][0] : spans[end][1]]))
                yield pd.DataFrame(rows, columns=["doc_id", "template", "coverage", "start", "end", "text"]).astype({"doc_id": "Int64"})

    out = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, template string, coverage double, start long, end long, text string")
    return out
