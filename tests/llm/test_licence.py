import duckdb
import pytest

from tidemark.llm import licence_scan as op

SF = "/root/testdata/sf0.001"
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this
   list of conditions and the following disclaimer in the documentation.
{name}THIS SOFTWARE IS PROVIDED BY THE AUTHOR "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
NAME = """3. Neither the name of X nor the names of its contributors may be used to endorse or
   promote products derived from this software without specific prior written permission.
"""
LGPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 2.1 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY. See the
GNU Lesser General Public License for more details.
"""


@pytest.mark.parametrize(
    "text, want",
    [
        (APACHE, ["Apache-2.0"]), (MIT, ["MIT"]), (BSD.format(name=""), ["BSD-2-Clause"]),
        (BSD.format(name=NAME), ["BSD-3-Clause"]), (LGPL, ["LGPL-2.1-or-later"]),
        ("Some prose. " + MIT + "\n\n" + APACHE, ["MIT", "Apache-2.0"]),
        ("Released under the MIT License.", ["MIT"]), ("licensed under GPLv2+", ["GPL-2.0-or-later"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]), ("released under the 3-clause BSD licence.", ["BSD-3-Clause"]),
        ("// SPDX-License-Identifier: GPL-2.0-or-later OR MIT\nint x;", ["GPL-2.0-or-later OR MIT"]),
        ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ["unknown"]),
        ("A driving licence and a warranty.", []), ("", []), (None, []),
    ],
)
def test_texts(text, want):
    assert [m.licence for m in op.scan(text)] == want


def test_spans_hold_the_sentences():
    text = "é before. " + APACHE + "after"
    (m,) = op.scan(text)
    assert "Licensed under" in text[m.start : m.end] and "AS IS" in text[m.start : m.end]
    assert m.sentences == ["apache-ref", "apache-use", "apache-copy", "apache-as-is"]


def test_no_sentence_lacks_a_stem():
    """The quick test for stems skips nothing that a pattern would find."""
    rows = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()
    for (text,) in rows:
        if not op.scan(text):
            plain = op.normalised(text or "")
            assert not any(p.search(plain) for name, p in op.KNOWN if name != "rights")


def test_frames(docs, none, spark):
    assert all(r.matches == [] for r in op.licences(docs).collect())
    assert op.licences(none).collect() == []
    df = spark.createDataFrame([(1, APACHE, 3), (1, APACHE, 3), (None, MIT, 4)], "doc_id bigint, text string, matches int")
    got = sorted(r.matches[0].licence for r in op.licences(df).collect())
    assert got == ["Apache-2.0", "Apache-2.0", "MIT"]


EXAMPLES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as-is": "The software is provided as is without warranty of any kind",
    "no-event": "In no event shall the authors be liable",
    "isc-grant": "Permission to use, copy, modify and distribute this software for any purpose with or without fee is hereby granted",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "bsd-name": "Neither the name of X may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "This software is provided by X as is and any express or implied warranties",
    "zlib-as-is": "This software is provided as is, without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "zlib-origin": "The origin of this software must not be misrepresented",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software",
    "apache-ref": "Licensed under the Apache License, Version 2.0",
    "apache-use": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis",
    "gpl-ref": "GNU General Public License version 3",
    "gpl-short": "Released under the GPL v3",
    "gpl-hope": "distributed in the hope that it will be useful, but without any warranty",
    "gpl-see": "See the GNU General Public License for more details",
    "gpl-received": "You should have received a copy of the GNU General Public License",
    "mpl-ref": "Released under the Mozilla Public License 2.0",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "mit-ref": "Released under the MIT License",
    "bsd-ref": "Released under the BSD licence",
    "isc-ref": "Released under the ISC license",
    "boost-ref": "Distributed under the Boost Software License, Version 1.0",
    "eclipse-ref": "Eclipse Public License 2.0",
    "artistic-ref": "Released under the Artistic License 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "unlicense-ref": "Released under the Unlicense",
    "wtfpl": "Do what the fuck you want to public license",
    "cc0-ref": "Released under CC0",
    "cc-ref": "Released under CC BY 4.0",
    "cc-long": "Creative Commons Attribution 4.0",
    "domain": "Released into the public domain",
    "mit-title": "The MIT License (MIT)",
    "isc-title": "ISC License",
    "bsd-title": "BSD 3-Clause License",
    "zlib-title": "zlib License",
    "apache-title": "Apache License Version 2.0, January 2004",
    "apache-grant": "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license",
    "apache-patent": "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license",
    "apache-or": "or the Apache License 2.0",
    "apache-name": "Apache License 2.0",
    "apache-adjective": "Apache 2.0 licensed",
    "gpl-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl-name": "GPL v3",
    "mpl-title": "Mozilla Public License Version 2.0",
    "mit-or": "or MIT license",
    "mit-adjective": "is MIT licensed",
}


def test_examples_pass_the_gate():
    assert set(EXAMPLES) == {name for name, _ in op.SENTENCES} - {"rights"}
    for name, text in EXAMPLES.items():
        for between in (" ", "  ", "\n", "\n// ", "\n * ", "\n# "):
            found = [f[0] for f in op.identified(between.join(text.split()))]
            assert name in found, (name, between)


@pytest.mark.parametrize(
    "text, want",
    [
        ("Released under the GPL v3.", ["GPL-3.0-only"]), ("Distributed under GPLv2 or later.", ["GPL-2.0-or-later"]),
        ("Available under LGPL 2.1+.", ["LGPL-2.1-or-later"]), ("It is released into the public\ndomain.", ["Public-Domain"]),
        ("Released under CC\nBY 4.0", ["CC-BY-4.0"]),
    ],
)
def test_short_and_wrapped(text, want):
    assert [m.licence for m in op.scan(text)] == want


GPL_HEAD = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
"""
APACHE_HEAD = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   2. Grant of Copyright License. Subject to the terms and conditions of
      this License, each Contributor hereby grants to You a perpetual,
      worldwide, non-exclusive, no-charge, royalty-free, irrevocable
      copyright license to reproduce the Work.

   3. Grant of Patent License. Subject to the terms and conditions of
      this License, each Contributor hereby grants to You a perpetual,
      worldwide, non-exclusive, no-charge, royalty-free, irrevocable
      (except as stated in this section) patent license to make the Work.
"""
MPL_HEAD = "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n--------------\n"


@pytest.mark.parametrize(
    "text, want",
    [
        ("MIT License", ["MIT"]), ("This project is MIT licensed.", ["MIT"]), ("License: MIT", ["MIT"]),
        ('"license": "MIT",', ["MIT"]), ("Apache-2.0", ["Apache-2.0"]), ("see GPL-2.0-or-later.", ["GPL-2.0-or-later"]),
        ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["Apache-2.0", "MIT"]),
        ("Licensed under either of MIT license or the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
        ("Licensed under the terms of the GNU GPL version 2.", ["GPL-2.0-only"]), ("GPLv3", ["GPL-3.0"]),
        ("The code is Apache 2.0 licensed.", ["Apache-2.0"]), ("Licence: Apache-2.0", ["Apache-2.0"]),
        (GPL_HEAD, ["GPL-3.0"]), (GPL_HEAD.replace("GENERAL", "AFFERO GENERAL"), ["AGPL-3.0"]),
        ("GNU LESSER GENERAL PUBLIC LICENSE\n  Version 2.1, February 1999\n\nPreamble", ["LGPL-2.1"]),
        (APACHE_HEAD, ["Apache-2.0"]), (APACHE_HEAD + "\n" + APACHE, ["Apache-2.0"]), (MPL_HEAD, ["MPL-2.0"]),
        ("MIT License\n\nCopyright (c) 2020 X\n\n" + MIT, ["MIT"]),
        ("BSD 3-Clause License\n\nCopyright X.\n\n" + BSD.format(name=NAME), ["BSD-3-Clause"]),
        ("// SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
        ("We drove the Apache 2.0 miles; submit the permit; er ging mit Lizenz.", []),
        ("A course at MIT. License plates differ.", []), ("An example-2.0 of a simple CC list.", []),
    ],
)
def test_titles_names_and_full_texts(text, want):
    assert [m.licence for m in op.scan(text)] == want


def test_scan_is_the_rules_applied_one_by_one():
    """Against a plain matcher: for each rule in order, every place where its identifiers stand unused."""
    rows = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()
    texts = [t for (t,) in rows] + [MIT + "\n\n" + APACHE + LGPL + BSD.format(name=NAME) + GPL_HEAD + APACHE_HEAD]
    n = 0
    for text in texts:
        found = op.identified(text or "")
        left = {i: f[0] for i, f in enumerate(found)}
        want = []
        for licence, sequence in op.RULES:
            i = 0
            while i < len(found):
                if [left.get(j) for j in range(i, i + len(sequence))] == list(sequence):
                    parts = [found[j] for j in range(i, i + len(sequence))]
                    want.append((i, next(p[1] for p in parts if p[1]) if licence == "*" else licence, parts[0][2], parts[-1][3]))
                    for j in range(i, i + len(sequence)):
                        del left[j]
                i += 1
        want += [(i, "unknown", found[i][2], found[i][3]) for i, name in left.items() if name != "rights"]
        assert [(m.licence, m.start, m.end) for m in op.scan(text)] == [w[1:] for w in sorted(want)]
        n += len(want)
    assert n >= 8
