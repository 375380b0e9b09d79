"""License scan by conditional compression.

Lines with a cue word form candidate blocks, with as many words before and after as the longest template has,
since the lines of a wrapped notice need not all have a cue. A block is compressed by zstandard alone and with each
template as a raw dictionary; the templates are ranked by how much smaller the block gets. In this order they are confirmed by the exact differences in wording: words of the template that
the block lacks, and words that it has in between. A match must hold ``SIMILARITY`` of the template's words, in order, every
word that sets it apart from templates of other licenses, and, of the words that name licenses and versions, just
those that the template has. The matched
words are then taken out of the block and the rest is scanned again, so one block may give several matches; a
block that none matches is cut into its sentences, or else its lines. A line with an SPDX identifier is a match by
itself (template -1). Blocks are cut at ``LONGEST`` words, so that very long lines take time in proportion to their length;
neighbouring parts share as many words as the longest template has.

Null or empty texts give no rows; repeated rows give their matches each time; a null doc_id is kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values: (license, wording) of common notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "MIT License"),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0-only", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("GPL-3.0", "Licensed under the GNU GPL v3."),
    ("GPL-2.0", "Licensed under the GNU GPL v2."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Released under the ISC License."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. The software is provided as is"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-1.1", "Licensed under the Apache Software License, Version 1.1."),
    ("EUPL-1.2", "Licensed under the European Union Public Licence, version 1.2."),
    ("Artistic-2.0", "Released under the Artistic License 2.0."),
    ("WTFPL", "Released under the Do What The Fuck You Want To Public License, Version 2."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0."),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal License."),
)

#: Words that name a license or its version. A match has just those that its template has: one that it lacks, or one more
#: inside it, makes it another license.
NAMING = frozenset(
    "1 1.0 1.1 1.2 2 2.0 2.1 2.5 3 3.0 4 4.0 9 v1 v1.0 v1.1 v2 v2.0 v2.1 v3 v3.0 v. lesser library affero documentation-license sharealike "
    "noderivatives noncommercial attribution attribution-sharealike attribution-noderivatives attribution-noncommercial "
    "attribution-noncommercial-sharealike attribution-noncommercial-noderivatives by by-sa by-nd by-nc by-nc-sa by-nc-nd cc0 "
    "apache mozilla eclipse boost artistic mit isc bsd gpl eupl 2-clause 3-clause 4-clause neither endorse fee granted appear".split()
)
_SPDX = re.compile(r"spdx-license-identifier:[ \t]*([a-z0-9.+-]+(?:[ \t]+(?:or|and|with)[ \t]+[a-z0-9.+-]+)*)", re.I)

SIMILARITY = 0.85
LEVEL = 19
LONGEST = 1024
CUE = r"licen[cs]e|licen[cs]ed|\bcc0?[ -]|copyright|permission|redistribut|public domain|creative commons|unencumbered|software"
_WORD = re.compile(r"[a-z0-9]+(?:[.'-][a-z0-9]+)*")
_END = re.compile(r"""[^.!?]*[.!?]["')]*(?:\s|\Z)""")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


#: (word, line, place in the line, whether a sentence ends with it)
Token = tuple[str, int, int, bool]


def tokens_of(lines: list[str], i: int) -> list[Token]:
    line = lines[i].lower()
    found = list(_WORD.finditer(line))
    starts = [m.start() for m in found[1:]] + [len(line)]
    return [(m[0], i, j, bool(_END.match(line[m.end() : z])) and not line[z : z + 1].isdigit()) for j, (m, z) in enumerate(zip(found, starts))]


def beside(lines: list[str], at: int, step: int, stop: int, least: int) -> list[Token]:
    """Words of the lines beside ``at``, up to ``stop`` or until there are ``least``."""
    found: list[list[Token]] = []
    i, n = at + step, 0
    while i != stop and n < least:
        found.append(tokens_of(lines, i))
        n += len(found[-1])
        i += step
    return [t for line in found[::step] for t in line]


def pieces(tokens: list[Token]) -> list[list[Token]]:
    """The sentences of a block, or else its lines; none if it can't be cut."""
    for cut in (lambda t, _: t[3], lambda t, after: t[1] != after[1]):
        edges = [0, *(i for i in range(1, len(tokens)) if cut(tokens[i - 1], tokens[i])), len(tokens)]
        if len(edges) > 2:
            return [tokens[x:z] for x, z in zip(edges, edges[1:])]
    return []


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        import zstandard as zstd

        self.names = [name for name, _ in templates]
        self.texts = [" ".join(words(text)) for _, text in templates]
        self.words = [text.split() for text in self.texts]
        self.plain = zstd.ZstdCompressor(level=LEVEL)
        as_dict = lambda t: zstd.ZstdCompressionDict(t.encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT)
        self.given = [zstd.ZstdCompressor(level=LEVEL, dict_data=as_dict(t)) for t in self.texts]
        self.own = [len(self.plain.compress(t.encode())) for t in self.texts]
        # of each pair of different licenses, the words that one has and the other lacks
        sets = [set(w) for w in self.words]
        shared = lambda a, b: len(sets[a] & sets[b]) * 4 >= len(sets[a]) * 3
        self.telling = [
            set().union(*(sets[a] - sets[b] for b in range(len(sets)) if self.names[a] != self.names[b] and shared(a, b))) for a in range(len(sets))
        ]

    def ranked(self, block: list[str]) -> list[tuple[float, int, int, int]]:
        """(reduction for each of the template's own bytes, template, bytes alone, bytes given the template), most bytes saved first."""
        data = " ".join(block).encode()
        alone = len(self.plain.compress(data))
        rows = []
        for k, compressor in enumerate(self.given):
            given = len(compressor.compress(data))
            rows.append(((alone - given) / self.own[k], k, alone, given))
        return sorted(rows, key=lambda r: (r[3] - r[2], -len(self.words[r[1]]), r[1]))

    def possible(self, block: list[str], k: int) -> bool:
        """Whether the block has words enough, in any order."""
        need = Counter(self.words[k])
        return self.telling[k] | (NAMING & set(need)) <= set(block) and sum((need & Counter(block)).values()) >= SIMILARITY * len(self.words[k])

    def wording(self, block: list[str], k: int, core: list[bool]) -> tuple[int, int, list[str], list[str], float] | None:
        """As ``compared``, at best without words of lines that have no cue and that stand apart from the rest."""
        runs = [m for m in SequenceMatcher(None, self.words[k], block, autojunk=False).get_matching_blocks() if m.size]
        near = list(runs)
        while len(near) > 1 and not any(core[near[0].b : near[0].b + near[0].size]) and near[1].b - near[0].b - near[0].size > 2 * near[0].size:
            near.pop(0)
        while len(near) > 1 and not any(core[near[-1].b : near[-1].b + near[-1].size]) and near[-1].b - near[-2].b - near[-2].size > 2 * near[-1].size:
            near.pop()
        return self.compared(block, k, near) or self.compared(block, k, runs)

    def compared(self, block: list[str], k: int, runs: list) -> tuple[int, int, list[str], list[str], float] | None:
        """Start and end of the template's words in the block, what it lacks, what it adds, share held."""
        template = self.words[k]
        while runs and len(runs) > 1:  # stray words far off are no part of it
            held = sum(m.size for m in runs)
            if runs[-1].b + runs[-1].size - runs[0].b <= 2 * len(template):
                break
            runs = runs[1:] if runs[0].size < runs[-1].size else runs[:-1]
        held = sum(m.size for m in runs)
        if held < SIMILARITY * len(template):
            return None
        inside = {i for m in runs for i in range(m.a, m.a + m.size)}
        missing = [w for i, w in enumerate(template) if i not in inside]
        if (self.telling[k] | NAMING) & set(missing):
            return None
        start, end = runs[0].b, runs[-1].b + runs[-1].size
        used = {j for m in runs for j in range(m.b, m.b + m.size)}
        extra = [block[j] for j in range(start, end) if j not in used]
        if NAMING & set(extra):
            return None
        return start, end, missing, extra, held / len(template)

    def matches(self, text: str) -> Iterator[tuple]:
        cue = re.compile(CUE)
        lines = text.split("\n")
        hits = [i for i, line in enumerate(lines) if cue.search(line.lower())]
        groups: list[list[int]] = []
        for i in hits:
            if groups and i - groups[-1][-1] <= 2:
                groups[-1].append(i)
            else:
                groups.append([i])
        reach, taken = max(map(len, self.words)), (0, 0)  # line and place after the last match
        for number, group in enumerate(groups):
            low, high = group[0], group[-1]
            before = beside(lines, low, -1, groups[number - 1][-1] if number else -1, reach)
            after = beside(lines, high, 1, len(lines), reach)
            core = [t for i in range(low, high + 1) for t in tokens_of(lines, i)]
            tokens = [t for t in before[-reach:] + core if t[1:3] >= taken] + after[:reach]
            at = 0
            while at < len(tokens):
                window = tokens[at : at + LONGEST]
                for found in self.in_block(window, low, high):
                    start, end, k, alone, given, gain, missing, extra, held = found
                    exact = not missing and not extra
                    apart = start[1] > high or end[1] < low
                    first, last = (start[1], end[1]) if apart else (min(low, start[1]), max(high, end[1]))
                    yield (number, first, last, self.names[k], k, alone, given, float(gain), " ".join(missing), " ".join(extra), held, "exact" if exact else "reworded")
                    taken = max(taken, (end[1], end[2] + 1))
                after_match = next((i for i, t in enumerate(tokens[at:], at) if t[1:3] >= taken), len(tokens))
                at = len(tokens) if at + LONGEST >= len(tokens) else max(at + LONGEST - 2 * reach, after_match)

    def in_block(self, window: list[Token], low: int, high: int) -> Iterator[tuple]:
        """Confirmed templates of a block, with their first and last token; ``low`` and ``high`` are its lines with a cue."""
        rest = [window]
        while rest:
            tokens = rest.pop(0)
            block = [t[0] for t in tokens]
            likely = {k for k in range(len(self.words)) if self.possible(block, k)}
            if not likely:
                continue
            for gain, k, alone, given in self.ranked(block):
                found = self.wording(block, k, [low <= t[1] <= high for t in tokens]) if gain > 0 and k in likely else None
                if found:
                    start, end, missing, extra, held = found
                    yield tokens[start], tokens[end - 1], k, alone, given, gain, missing, extra, held
                    rest[:0] = [tokens[:start], tokens[end:]]
                    break
            else:
                rest[:0] = pieces(tokens)


def identifiers(text: str) -> Iterator[tuple]:
    """Lines with an SPDX identifier, as matches."""
    line, at = 0, 0
    for m in _SPDX.finditer(text):
        line, at = line + text.count("\n", at, m.start()), m.start()
        yield (-1, line, line, m[1], -1, len(m[0]), 0, 1.0, "", "", 1.0, "exact")


SCHEMA = (
    "doc_id {}, block int, first_line int, last_line int, license string, template int, bytes_alone int, bytes_given int, "
    "reduction double, missing string, extra string, similarity double, verdict string"
)


def license_scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per confirmed notice: where it stands, which license, sizes, and the differences in wording."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    likely = docs.select("doc_id", "text").where(F.col("text").rlike(f"(?i)(?:{CUE})"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        types = [pa.int32()] * 3 + [pa.string()] + [pa.int32()] * 3 + [pa.float64(), pa.string(), pa.string(), pa.float64(), pa.string()]
        names = ["doc_id", "block", "first_line", "last_line", "license", "template", "bytes_alone", "bytes_given", "reduction", "missing", "extra", "similarity", "verdict"]
        for rows in batches:
            keys, out = rows.column(0).to_pylist(), []
            for key, text in zip(keys, rows.column(1).to_pylist()):
                out += [(key, *m) for m in (*identifiers(text or ""), *scanner.matches(text or ""))]
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [rows.schema.field(0).type, *types])], names=names)

    return likely.mapInArrow(run, SCHEMA.format(kind))
