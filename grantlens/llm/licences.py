"""Licence texts inside documents, by the Dice coefficient of word bigrams.

Texts are reduced to lower-case words of letters and digits.  A stretch of a document is
compared with a template by the Dice coefficient of their bigrams, counted with
repetition: twice what they share over what both have.  A stretch can only reach
``threshold`` if it has between ``threshold / (2 - threshold)`` and its inverse times as many bigrams as
the template, and if enough of the template's bigrams lie that close together; both
bounds are checked before anything is compared, and most texts hold no bigram of most templates.

A template whose name and text state a version (GPL-3.0) only matches a stretch that states the
same one, inside or in the two words behind it.  A licence without one (GPL, CC-BY) only
matches where no version and no further condition follows.

Of the stretches that reach the threshold, the best come first, and none that
overlaps a better one is reported.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from grantlens.llm.licence_texts import WHOLE

THRESHOLD = 0.8

# Wording of licence notices and grants.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
        " furnished to do so, subject to the following conditions: The above copyright notice and this"
        " permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
        " fee is hereby granted, provided that the above copyright notice and this permission notice appear"
        " in all copies."
    ),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        " writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the"
        " License, or (at your option) any later version."
    ),
}


def _gnu() -> dict[str, str]:
    """Notices and file headers of the GNU licences, by family and version."""
    found = {}
    for family, title in (
        ("GPL", "GNU General Public License"),
        ("LGPL", "GNU Lesser General Public License"),
        ("LGPL-library", "GNU Library General Public License"),
        ("AGPL", "GNU Affero General Public License"),
    ):
        name = family.partition("-")[0]
        rest = family[len(name) :]
        for version in ("1.0", "2.0", "2.1", "3.0"):
            number = version.removesuffix(".0")
            found[f"{name}-{version}{rest}"] = f"This work is licensed under the {title}, version {number}."
            found[f"{name}-{version}{rest}-notice"] = f"Licensed under the {title}, version {number}."
            found[f"{name}-{version}{rest}-header"] = (
                f"This program is free software: you can redistribute it and/or modify it under the terms of the"
                f" {title} as published by the Free Software Foundation, either version {number} of the"
                f" License, or (at your option) any later version."
            )
            found[f"{name}-{version}{rest}-only-header"] = (
                f"This program is free software; you can redistribute it and/or modify it under the terms of the"
                f" {title} version {number} as published by the Free Software Foundation."
            )
            found[f"{name}-{version}{rest}-title"] = (
                f"{title} Version {number} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to"
                f" copy and distribute verbatim copies of this license document, but changing it is not allowed."
            )
        found[f"{name}{rest}"] = f"This work is licensed under the {title}."
        found[f"{name}{rest}-notice"] = f"Licensed under the {title}."
    for version in ("1.1", "1.2", "1.3"):
        found[f"GFDL-{version}"] = (
            "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free"
            f" Documentation License, Version {version} or any later version published by the Free Software"
            " Foundation;"
        )
        found[f"GFDL-{version}-notice"] = f"Licensed under the GNU Free Documentation License, version {version}."
    return found


def _creative_commons() -> dict[str, str]:
    """Short and long notices of the six Creative Commons licences, by version."""
    by, nc, sa, nd = (
        ["Attribution"],
        ["NonCommercial", "Non-Commercial"],
        ["ShareAlike", "Share-Alike"],
        ["NoDerivatives", "NoDerivs", "No-Derivatives", "No Derivative Works"],
    )
    kinds = {"BY": [by], "BY-NC": [by, nc], "BY-SA": [by, sa], "BY-ND": [by, nd]}
    kinds |= {"BY-NC-SA": [by, nc, sa], "BY-NC-ND": [by, nc, nd]}
    regions = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
    found = {}
    for kind, parts in kinds.items():
        long = ["-".join(words) for words in itertools.product(*parts)]
        found[f"CC-{kind}"] = f"Licensed under CC {kind}."
        for i, words in enumerate(long):
            found[f"CC-{kind}-long" + f"-{'abcdefgh'[i]}" * (i > 0)] = (
                f"This work is licensed under a Creative Commons {words} License."
            )
        for version, region in regions.items():
            found[f"CC-{kind}-{version}"] = f"Licensed under CC {kind} {version}."
            for i, words in enumerate(long):
                found[f"CC-{kind}-{version}-long" + f"-{'abcdefgh'[i]}" * (i > 0)] = (
                    f"This work is licensed under a Creative Commons {words} {version} {region} License."
                )
    return found


_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met: Redistributions of source code must retain the above copyright notice, this"
    " list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above"
    " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
    " materials provided with the distribution. "
)
_BSD_ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following"
    " acknowledgement: This product includes software developed by the copyright holder. "
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission. "
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
    " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
    " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY"
    " DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,"
    " PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER"
    " CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE"
    " OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH"
    " DAMAGE."
)

for _name, _wording in (
    _gnu()
    | _creative_commons()
    | {
        "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
        "MIT-licensed": "Licensed under the MIT License.",
        "ISC-notice": "Licensed under the ISC License.",
        "BSD-notice": "Licensed under the BSD License.",
        "BSD-2-Clause-notice": "Licensed under the BSD 2-Clause License.",
        "BSD-3-Clause-notice": "Licensed under the BSD 3-Clause License.",
        "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
        "BSD-3-Clause": _BSD_HEAD + _BSD_NAMES + _BSD_TAIL,
        "BSD-4-Clause": _BSD_HEAD + _BSD_ADVERTISING + _BSD_NAMES + _BSD_TAIL,
        "MPL-1.1": "Licensed under the Mozilla Public License, version 1.1.",
        "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
        "MPL-1.1-header": (
            "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may"
            " not use this file except in compliance with the License. You may obtain a copy of the License at"
            " http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an \"AS IS\" basis,"
            " WITHOUT WARRANTY OF ANY KIND, either express or implied."
        ),
        "MPL-2.0-header": (
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
            " MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
        ),
        "CC0-1.0": "Licensed under CC0 1.0 Universal.",
        "CC0-1.0-notice": "This work is dedicated to the public domain under CC0 1.0.",
        "CC0-waiver": (
            "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring"
            " rights to this software to the public domain worldwide. This software is distributed without any"
            " warranty."
        ),
        "CC0-mark": (
            "To the extent possible under law, the person who associated CC0 with this work has waived all copyright"
            " and related or neighboring rights to this work."
        ),
        "Unlicense": (
            "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
            " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
            " binary, for any purpose, commercial or non-commercial, and by any means."
        ),
        "Unlicense-text": (
            "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
            " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
            " binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize"
            " copyright laws, the author or authors of this software dedicate any and all copyright interest in the"
            " software to the public domain. We make this dedication for the benefit of the public at large and to the"
            " detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in"
            " perpetuity of all present and future rights to this software under copyright law."
        ),
        "MIT-text": TEMPLATES["MIT"] + (
            " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
            " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO"
            " EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER"
            " IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE"
            " USE OR OTHER DEALINGS IN THE SOFTWARE."
        ),
    }
    | WHOLE
).items():
    # Wordings given above stay as they are.
    TEMPLATES.setdefault(_name, _wording)

# Names of licences that a version or a further condition would make another.
_BARE = re.compile(r"(?:A|L)?GPL(?:-library)?(?:-notice)?|CC-BY(?:-NC|-SA|-ND)*(?:-long(?:-[a-h])?)?")
_CONDITIONS = frozenset("nc nd sa noncommercial noderivatives noderivs sharealike".split())
# A version behind a stretch counts if it is one of this many words.
_BEHIND = 2

_WORD = re.compile(r"[^\W_]+")
# A number that stands by itself, with the word for version before it.
_NUMBER = re.compile(r"(?<![^\W_])(?:v(?:er(?:sion)?)?\b\.?\s*|v)?(\d+(?:\.\d+)*)(?![^\W_])", re.I | re.A)
_IN_NAME = re.compile(r"-(\d+(?:\.\d+)+)(?=-|$)")
_SENTENCE_END = re.compile(r"[.!?;]\s|\n")
# (start, end, licence, dice); positions are code points of the text.
Found = tuple[int, int, str, float]
# First and last word, whether it goes on the sentence before it, version.
Number = tuple[int, int, bool, str]


def _version(number: str) -> str:
    return re.sub(r"(?:\.0+)+$", "", number)


class Words:
    """Words of a text with their places, and the numbers among them."""

    def __init__(self, text: str):
        self.text = text
        words = list(_WORD.finditer(text.lower())) if len(text.lower()) == len(text) else _slow_words(text)
        self.plain = [word.group() if isinstance(word, re.Match) else word[0] for word in words]
        self.bounds = [_bounds(word) for word in words]
        self._numbers: list[Number] | None = None

    def numbers(self) -> list[Number]:
        if self._numbers is None:
            starts = [start for start, _ in self.bounds]
            self._numbers = []
            for match in _NUMBER.finditer(self.text):
                first = bisect_right(starts, match.start(1)) - 1
                last = bisect_right(starts, match.end(1) - 1) - 1
                # The words before the number, or before the word for version, that it may belong to.
                before = bisect_right(starts, match.start()) - 1
                low = self.bounds[max(0, before - _BEHIND)][1]
                goes_on = not _SENTENCE_END.search(self.text, low, match.start())
                self._numbers.append((first, last, goes_on, _version(match.group(1))))
        return self._numbers


class Template:
    def __init__(self, name: str, text: str):
        words = _WORD.findall(text.lower())
        if len(words) < 2:
            raise ValueError(f"template {name} has fewer than two words")
        self.name = name
        self.bigrams = Counter(zip(words, words[1:]))
        self.size = len(words) - 1
        stated = {_version(match.group(1)) for match in _NUMBER.finditer(text)}
        named = _IN_NAME.search(name)
        # The version a stretch has to state, if the template has one in its name and its text.
        self.version = _version(named[1]) if named and _version(named[1]) in stated else None
        self.bare = bool(_BARE.fullmatch(name))

    def _numbers(self, words: Words) -> list[Number] | None:
        """Numbers that decide whether a stretch is of this licence."""
        if self.bare:
            return words.numbers()
        if self.version is not None:
            return [number for number in words.numbers() if number[3] == self.version]
        return None

    def _allowed(self, words: Words, numbers: list[Number], firsts: list[int], first: int, last: int) -> bool:
        """Whether the stretch states the version, or for a bare licence none and no further condition."""
        at = bisect_left(firsts, first)
        stated = False
        if at < len(numbers):
            low, high, goes_on, _ = numbers[at]
            stated = high <= last + 1 or (last + 1 < low <= last + 1 + _BEHIND and goes_on)
        if self.bare:
            return not stated and words.plain[last + 2 : last + 3] not in [[one] for one in _CONDITIONS]
        return stated

    def _most_shared(self, bigrams: list[tuple[str, str]], at: list[int], within: list[int]) -> list[int]:
        """How many of its bigrams the longest stretch from each of ``at`` has, with repetition."""
        seen: Counter = Counter()
        shared, end, most = 0, 0, []
        for k, place in enumerate(at):
            while end < k + within[k]:
                bigram = bigrams[at[end]]
                seen[bigram] += 1
                shared += seen[bigram] <= self.bigrams[bigram]
                end += 1
            most.append(shared)
            bigram = bigrams[place]
            shared -= seen[bigram] <= self.bigrams[bigram]
            seen[bigram] -= 1
        return most

    def stretches(self, bigrams: list[tuple[str, str]], at: list[int], threshold: float, words: Words):
        """(dice, first, last) of the best stretch from each bigram of the template in ``at``.

        A best stretch starts and ends with a bigram of the template, because any other at its end
        only adds to its size.
        """
        # Sharing s of its n, with at least s of its own, dice is 2 s / (n + s) at most.
        needed = threshold * self.size / (2 - threshold) - 1e-9
        if len(at) < needed:
            return
        longest = int(self.size * (2 - threshold) / threshold + 1e-9)
        places = np.array(at)
        within = np.searchsorted(places, places + longest) - np.arange(len(places))
        if within.max() < needed:
            return
        numbers = self._numbers(words)
        if numbers == [] and not self.bare:
            return
        firsts = [number[0] for number in numbers or ()]
        most = np.array(self._most_shared(bigrams, at, within.tolist()))
        for k in np.flatnonzero(most >= needed).tolist():
            seen: Counter = Counter()
            shared, best = 0, (0.0, 0)
            for last in at[k : k + int(within[k])]:
                bigram = bigrams[last]
                seen[bigram] += 1
                shared += seen[bigram] <= self.bigrams[bigram]
                dice = 2 * shared / (self.size + last - at[k] + 1)
                if dice >= threshold and (dice, last) > best:
                    if numbers is None or self._allowed(words, numbers, firsts, at[k], last):
                        best = (dice, last)
            if best[0] >= threshold:
                yield best[0], at[k], best[1]


def find_licences(text: str, templates: list[Template], owners: Mapping, threshold: float) -> list[Found]:
    """Licences of a text by position.  ``owners``: bigram -> numbers of the templates that have it."""
    words = Words(text)
    bigrams = list(zip(words.plain, words.plain[1:]))
    places: dict[int, list[int]] = {}
    for i, bigram in enumerate(bigrams):
        for owner in owners.get(bigram, ()):
            places.setdefault(owner, []).append(i)
    stretches = [
        (-dice, first, last, owner)
        for owner, at in places.items()
        for dice, first, last in templates[owner].stretches(bigrams, at, threshold, words)
    ]
    taken, found = [], []
    for dice, first, last, owner in sorted(stretches):
        if all(last + 1 < low or high + 1 < first for low, high in taken):
            taken.append((first, last))
            start, end = words.bounds[first][0], words.bounds[last + 1][1]
            found.append((start, end, templates[owner].name, -dice))
    return sorted(found)


def _slow_words(text: str) -> list[tuple[str, int, int]]:
    """Words where lower case changes the length of the text: each is lowered by itself."""
    return [(word.group().lower(), *word.span()) for word in _WORD.finditer(text)]


def _bounds(word) -> tuple[int, int]:
    return word.span() if isinstance(word, re.Match) else word[1:]


def licences(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per licence found: doc_id, licence, start, end, dice.

    Positions are code points of the text, ends exclusive.  NULL and empty texts hold none.
    Repeated rows are scanned as often as they come; NULL ids are carried along.  Of equally good
    stretches that overlap the first is reported, then by order of the templates.  An
    empty table gives an empty result; other columns are not read.
    """
    known = dict(templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Template(name, wording) for name, wording in known.items()]
        owners: dict = {}
        for number, template in enumerate(ready):
            for bigram in template.bigrams:
                owners.setdefault(bigram, []).append(number)
        for batch in batches:
            rows, found = [], []
            for row, cell in enumerate(batch.column(1)):
                for one in find_licences(cell.as_py() or "", ready, owners, threshold):
                    rows.append(row)
                    found.append(one)
            starts, ends, names, dices = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(names, pa.string()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                    pa.array(dices, pa.float64()),
                ],
                ["doc_id", "licence", "start", "end", "dice"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        scan, f"doc_id {kind}, licence string, start long, end long, dice double"
    )
