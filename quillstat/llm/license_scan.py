"""Licence notices by conditional compression.

A candidate block is a run of lines near a cue word ("licen", "copyright", ...). Every template
serves as a raw zstandard dictionary: the better it describes the block, the smaller the block
becomes. Templates are ranked by that reduction, and in this order the first is taken whose
wording the block has: words missing from the template and words added inside the matched
stretch are listed, and short notices must have none of either. Words of a slot (<year>,
<holder>) may stand for anything. What a winner covers is cut out and the rest of the block is
looked at again, so neighbouring notices are all found.

In a long line a notice saves only a small share of the block. Where the whole block confirms
nothing, every cue word is therefore judged by the stretch around it, for each template as many
words as a notice of its length needs, and templates are ranked by the bytes they save there. A
block of more than ``LONGEST_BLOCK_KEPT`` characters is judged in this way from the start.

Blocks repeat a lot, so a block is compressed once per worker and its findings kept, within a
bound. Whole texts are read; there is no shuffle.

Defined cases: null and empty texts and texts without a cue give no row; a block that no
template confirms gives one row with ``confirmed`` false and the best-ranked template, if it
shrinks the block by ``LEAST_REDUCTION`` at least, or a row for each stretch that has half of a
template's words and is shrunk as much; ties in reduction go to the template that
comes first in the list; repeated rows give repeated findings; other columns play no part.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.common import Memo, frames, small_batches, text_or_empty

LEAST_REDUCTION = 0.25
SHORT_WORDS = 14
LOOSE_SHARE = 0.1
JOIN_LINES = 3
ROOM = 16  # words beside a notice, or of a slot, in the stretch around a cue
BLOCKS_KEPT = 20_000
LONGEST_BLOCK_KEPT = 4000

# Words that make a line worth a closer look.
CUES = ("licen", "copyright", "permission", "warrant", "redistribut", "rights reserved", "public domain", "spdx",
        "creative commons", "©")

# Wording of common notices; <...> stands for words that differ from case to case.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MIT-notice": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Affero General Public License for more details."),
    "LGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Lesser General Public License for more details."),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of <holder> nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software."),
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "All-rights-reserved": "All rights reserved.",
    "Copyright-line": "Copyright (c) <year> <holder>. All rights reserved.",
}

# SPDX identifiers that a one-line tag may name.
SPDX = ("MIT Apache-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only "
        "LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later BSD-2-Clause "
        "BSD-3-Clause ISC MPL-2.0 EPL-2.0 Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0").split()
TEMPLATES |= {f"{name}-spdx": f"SPDX-License-Identifier: {name}" for name in SPDX}

WORD = re.compile(r"<\w+>|\w+")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    bare = zstandard.ZstdCompressionParameters.from_level(
        9, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = dictionary and zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=bare, **({"dict_data": held} if held else {}))


def differences(block: list[str], template: list[str]) -> tuple[list[str], list[str], int, int]:
    """(words of the template that are missing, words added inside the matched stretch, first and
    last word of that stretch); a slot takes the words in its place."""
    match = difflib.SequenceMatcher(None, block, template, autojunk=False)
    same = [m for m in match.get_matching_blocks() if m.size]
    if not same:
        return template, [], 0, 0
    first, last = same[0].a, same[-1].a + same[-1].size
    missing, extra = [], []
    for kind, a1, a2, b1, b2 in match.get_opcodes():
        if kind == "equal":
            continue
        lost = template[b1:b2]
        slots = [w for w in lost if w.startswith("<")]
        missing += [w for w in lost if not w.startswith("<")]
        if not slots and a1 >= first and a2 <= last:
            extra += block[a1:a2]
    return missing, extra, first, last


class Scanner:
    """Finds notices in whole texts."""

    def __init__(self):
        self.plain = _compressor(None)
        self.templates = [(name, words(text), _compressor(text.lower().encode())) for name, text in TEMPLATES.items()]
        self.wording = {name: ws for name, ws, _ in self.templates}
        self.vocabulary = {w for _, ws, _ in self.templates for w in ws}
        self.blocks = Memo(self._findings, BLOCKS_KEPT, LONGEST_BLOCK_KEPT)

    def reductions(self, block: str) -> list[tuple[float, str]]:
        """(share of the compressed size that a template saves, its name), best first."""
        body = block.lower().encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(body))
        ranked = [(1 - len(c.compress(body)) / alone, -k, name) for k, (name, _, c) in enumerate(self.templates)]
        return [(gain, name) for gain, _, name in sorted(ranked, reverse=True)]

    def _findings(self, block: str) -> list[tuple[int, int, str, float, list[str], list[str], bool]]:
        """(start, end, licence, reduction, missing, extra, confirmed) of a block; offsets within it."""
        out = []
        todo = [(0, len(block))]
        while todo:
            first, last = todo.pop()
            part = block[first:last]
            if not any(c in part.lower() for c in CUES):
                continue
            places = [m.span() for m in WORD.finditer(part)]
            held = [w.lower() for w in WORD.findall(part)]
            if not held:
                continue
            found = self._whole(held, places, part) if len(part) <= LONGEST_BLOCK_KEPT else []
            found = found or self._around_cues(held, places, part)
            sure = [f for f in found if f[-1]]
            if not sure:
                out += [(first + a, first + b, *rest) for a, b, *rest in self._doubtful(held, places, part) or found]
                continue
            at = 0
            for a, b, *rest in sure:
                out.append((first + a, first + b, *rest))
                todo.append((first + at, first + a))
                at = b
            todo.append((first + at, last))
        return sorted(out, key=lambda f: f[:2])

    def _whole(self, held: list[str], places: list[tuple[int, int]], part: str) -> list[tuple]:
        """The notice that the ranking over the whole part confirms, if any."""
        for gain, name in self.reductions(part):
            if gain < LEAST_REDUCTION / 4:
                break
            sure, missing, extra, first, last = self._wording(held, name)
            if sure:
                return [(places[first][0], places[last - 1][1], name, gain, missing, extra, True)]
        return []

    def _wording(self, held: list[str], name: str) -> tuple[bool, list[str], list[str], int, int]:
        template = self.wording[name]
        allowed = 0 if len(template) <= SHORT_WORDS else int(LOOSE_SHARE * len(template))
        here = set(held)
        absent = [w for w in template if not w.startswith("<") and w not in here]
        if len(absent) > allowed:
            return False, absent, [], 0, 0
        missing, extra, first, last = differences(held, template)
        return last > first and len(missing) <= allowed and len(extra) <= allowed, missing, extra, first, last

    def _doubtful(self, held: list[str], places: list[tuple[int, int]], part: str) -> list[tuple]:
        """The best-ranked template of an unconfirmed part, if it saves enough of the whole."""
        gain, name = self.reductions(part)[0]
        if gain < LEAST_REDUCTION:
            return []
        missing, extra, first, last = differences(held, self.wording[name])
        return [(places[first][0], places[last - 1][1], name, gain, missing, extra, False)] if last > first else []

    def _around_cues(self, held: list[str], places: list[tuple[int, int]], part: str) -> list[tuple]:
        """Notices around the cue words from left to right, none over another; unconfirmed ones only
        where the matched stretch alone is shrunk enough and has half of the template's words."""
        low = part.lower()
        if len(low) != len(part):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in part)
        starts = [a for a, _ in places]
        cues = sorted({max(0, bisect_right(starts, i) - 1) for c in CUES for i in _all(low, c)})
        sure, doubtful = [], []
        done = unsure = 0
        for cue in cues:
            if cue < done:
                continue
            ranked = []
            for k, (name, template, compressor) in enumerate(self.templates):
                reach = 2 * len(template) + ROOM
                a, b = max(done, cue - reach), min(len(held), cue + reach)
                here = set(held[a:b])
                if 2 * sum(w not in here for w in template if not w.startswith("<")) > len(template):
                    continue
                body = part[places[a][0]:places[b - 1][1]].lower().encode("utf-8", "surrogatepass")
                alone = len(self.plain.compress(body))
                saved = alone - len(compressor.compress(body))
                ranked.append((saved, saved / alone, -k, name, a, b))
            ranked.sort(reverse=True)
            for saved, gain, _, name, a, b in ranked:
                ok, missing, extra, first, last = self._wording(held[a:b], name)
                if ok and saved > 0:
                    sure.append((places[a + first][0], places[a + last - 1][1], name, gain, missing, extra, True))
                    done = a + last
                    break
            else:
                for saved, gain, _, name, a, b in ranked[:1]:
                    missing, extra, first, last = differences(held[a:b], self.wording[name])
                    if last > first and a + first >= unsure and 2 * len(missing) <= len(self.wording[name]):
                        start, end = places[a + first][0], places[a + last - 1][1]
                        gain = {n: g for g, n in self.reductions(part[start:end])}[name]
                        if gain >= LEAST_REDUCTION:
                            doubtful.append((start, end, name, gain, missing, extra, False))
                            unsure = a + last
        clear = [f for f in doubtful if all(f[1] <= s[0] or f[0] >= s[1] for s in sure)]
        return sorted(sure + clear, key=lambda f: f[:2])

    def _candidates(self, text: str) -> Iterator[tuple[int, int]]:
        """Ranges of candidate blocks: runs of cue lines, gaps of few lines filled, with
        neighbouring lines that are made of template words."""
        low = text.lower()
        if len(low) != len(text):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        hits = sorted({text.count("\n", 0, i) for c in CUES for i in _all(low, c)}) if any(c in low for c in CUES) else []
        if not hits:
            return
        lines = text.split("\n")
        ends = []
        at = 0
        for line in lines:
            at += len(line) + 1
            ends.append(at)
        runs: list[list[int]] = []
        for k in hits:
            if runs and k - runs[-1][1] <= JOIN_LINES:
                runs[-1][1] = k
            else:
                runs.append([k, k])
        done = -1
        for first, last in runs:
            if first <= done:
                first = done + 1
            while first - 1 > done and self._legal(lines[first - 1]):
                first -= 1
            while last + 1 < len(lines) and self._legal(lines[last + 1]):
                last += 1
            if first > last:
                continue
            done = last
            yield (ends[first - 1] if first else 0), ends[last] - 1

    def _legal(self, line: str) -> bool:
        held = words(line)
        return len(held) >= 3 and sum(w in self.vocabulary for w in held) >= 0.7 * len(held)

    def __call__(self, text: str) -> list[tuple[int, int, str, float, list[str], list[str], bool]]:
        out = []
        for start, end in self._candidates(text):
            out += [(start + a, start + b, *rest) for a, b, *rest in self.blocks[text[start:end]]]
        return out


def _all(text: str, cue: str) -> Iterator[int]:
    at = text.find(cue)
    while at >= 0:
        yield at
        at = text.find(cue, at + 1)


COLUMNS = ["block", "start", "end", "license", "reduction", "missing", "extra", "confirmed"]
SCHEMA = ("block int, start int, end int, license string, reduction double, missing array<string>, "
          "extra array<string>, confirmed boolean")


def license_notices(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and one row per notice: its number in the text, character range, licence, share saved by
    the template, words missing and added, and whether the wording is confirmed."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = Scanner()
        for batch in batches:
            found = ((None if missing else int(doc), k, *f)
                     for doc, missing, body in zip(batch[key], batch[key].isna(), batch[text])
                     for k, f in enumerate(scan(body)))
            for frame in frames([key, *COLUMNS], found):
                frame[key] = frame[key].astype("Int64")
                yield frame

    rows = df.select(F.col(key).cast("long").alias(key), text_or_empty(text).alias(text))
    return rows.mapInPandas(run, f"`{key}` long, {SCHEMA}")
