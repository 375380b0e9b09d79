"""Usual notices, each under its own name and no other."""

import textwrap
import time

import pytest

from rankloom.llm.license_scan import LONGEST, Scanner, identifiers, license_scan
from tests.llm.edge import prose

FSF = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version."
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
CC = "This work is licensed under a Creative Commons Attribution{0} {1} License."
NOTICES = [
    ("GPL-2.0", FSF.format("program", "", "2")),
    ("GPL-3.0", FSF.format("program", "", "3").replace(";", ":", 1)),
    ("LGPL-2.0", FSF.format("library", "Library ", "2")),
    ("LGPL-2.1", FSF.format("library", "Lesser ", "2.1")),
    ("LGPL-3.0", FSF.format("program", "Lesser ", "3")),
    ("AGPL-3.0", FSF.format("program", "Affero ", "3")),
    ("GPL-2.0-only", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use'),
    ("MIT", "MIT License"),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES'),
    ("0BSD", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES'),
    ("BSD-3-Clause", BSD + THIRD + WARRANTY),
    ("BSD-2-Clause", BSD + WARRANTY),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-1.1", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License.'),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", CC.format("", "4.0 International")),
    ("CC-BY-SA-4.0", CC.format("-ShareAlike", "4.0 International")),
    ("CC-BY-ND-4.0", CC.format("-NoDerivatives", "4.0 International")),
    ("CC-BY-NC-4.0", CC.format("-NonCommercial", "4.0 International")),
    ("CC-BY-NC-SA-4.0", CC.format("-NonCommercial-ShareAlike", "4.0 International")),
    ("CC-BY-NC-ND-4.0", CC.format("-NonCommercial-NoDerivatives", "4.0 International")),
    ("CC-BY-3.0", CC.format("", "3.0 Unported")),
    ("CC-BY-SA-3.0", CC.format("-ShareAlike", "3.0 Unported")),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Artistic-2.0", "Released under the Artistic License 2.0."),
]


@pytest.fixture(scope="module")
def scanner():
    return Scanner()


@pytest.mark.parametrize("name,notice", NOTICES)
def test_notice(scanner, name, notice):
    for text in (notice, "\n".join(f"// {line}" for line in textwrap.wrap(notice, 72, break_on_hyphens=False)), f"{prose(5, 40)} {notice} {prose(6, 40)}"):
        assert [m[3] for m in scanner.matches(text)] == [name], text


def test_other_versions_are_no_match(scanner):
    for text in (FSF.format("program", "", "4"), CC.format("", "2.0 Generic"), "Licensed under the Apache License, Version 9.", "Released under the BSD 5-Clause License."):
        assert list(scanner.matches(text)) == []


def test_identifiers(spark):
    text = "code\n# SPDX-License-Identifier: MIT\nmore\n/* SPDX-License-Identifier: Apache-2.0 OR GPL-2.0-only */"
    assert [(m[1], m[3]) for m in identifiers(text)] == [(1, "MIT"), (3, "Apache-2.0 OR GPL-2.0-only")]
    docs = spark.createDataFrame([(1, "SPDX-License-Identifier: MIT"), (2, "MIT License"), (3, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.license) for r in license_scan(docs).collect()) == [(1, "MIT"), (2, "MIT")]


def test_a_very_long_line_takes_linear_time(scanner):
    """Notices on one line: all are found, twice the text takes about twice the time."""
    took = []
    for n in (20, 40, 80):
        text = " ".join(f"{prose(k, 90)} {NOTICES[k % 6][1]}" for k in range(n))
        started = time.process_time()
        assert sorted(m[3] for m in scanner.matches(text)) == sorted(NOTICES[k % 6][0] for k in range(n))
        took.append(time.process_time() - started)
    assert len(text.split()) > 4 * LONGEST and took[2] < 8 * max(took[0], 0.2)
