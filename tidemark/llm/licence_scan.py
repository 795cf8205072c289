"""Licence recognition by sentences and rules.

A text is cut into sentences, which are normalised (case, punctuation, line
breaks, comment signs, spelling of "licence" and of version numbers). Known
licence sentences have identifiers; where one may name a licence in many
versions, the version becomes part of the identifier. A text's identifiers, in
order, are then matched against licence rules, each an ordered sequence of
identifiers: longer rules first, each identifier used once. A licence's full
text, its title, its usual header and a plain reference are rules of their own.
A text of the GPL, or its bare name, names a version; only a reference that grants
it says whether later ones apply ("-only", "-or-later").
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import by_value, col

by_value(__name__)

#: Every known sentence but that of all rights (which no rule uses) holds one of these, or "cc" as a word.
#: Each is a run of letters in one word, so that line breaks and comment signs cannot part it.
STEMS = (
    "licen", "warrant", "redistribut", "permission", "copyright", "liable", "misrepresented", "endorse",
    "acknowledgement", "obtain", "gpl", "unencumbered", "domain", "creative", "cc0",
)
CC = re.compile(r"(?<![a-z0-9])cc(?![a-z0-9])")

#: (identifier, pattern over a normalised sentence). Fixed wording of public licences; named groups
#: become part of the identifier.
SENTENCES = [
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is", r"(?:the )?software is provided as is (?:and the author disclaims all warranties|without warranty of any kind)"),
    ("no-event", r"in no event shall the (?:authors?|copyright holders?|copyright owner|regents)(?: or (?:copyright holders|contributors))? be liable"),
    ("isc-grant", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-advert", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-name", r"neither the names? of .{0,200}? may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-as-is", r"this software is provided by .{0,200}?as is and any express or implied warranties"),
    ("zlib-as-is", r"this software is provided as is without any express or implied warranty"),
    ("zlib-grant", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("zlib-origin", r"the origin of this software must not be misrepresented"),
    ("zlib-altered", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("mit-title", r"^(?:the )?(?:mit|expat) license(?: mit)?$"),
    ("isc-title", r"^(?:the )?isc license(?: isc)?$"),
    ("bsd-title", r"^(?:the )?(?:bsd (?P<clauses>[234]) clause|(?P<after>[234]) clause bsd) (?:\w+ ){0,4}license$"),
    ("zlib-title", r"^(?:the )?zlib license$"),
    ("apache-title", r"apache license version (?P<version>\d\.\d) january 2004"),
    ("apache-grant", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-patent", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent license"),
    ("apache-ref", r"(?:licen[sc]ed|released|distributed|available) under (?:either of |the terms of )?(?:the )?apache license version (?P<version>\d(?:\.\d)?)"),
    ("apache-or", r"or (?:the )?apache license(?: version)? (?P<version>\d(?:\.\d)?)"),
    ("apache-name", r"apache license(?: version)? (?P<version>[12]\.\d)"),
    ("apache-adjective", r"apache (?:version )?(?P<version>[12](?:\.\d)?) licensed?"),
    ("apache-use", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at"),
    ("apache-as-is", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl-title", r"^gnu (?P<kind>affero |lesser |library )?general public license version (?P<version>\d(?:\.\d)?) (?:\d{1,2} )?(?:february|june|november) \d{4}"),
    ("gpl-ref", r"gnu (?P<kind>affero |lesser |library )?general public license(?: agpl| lgpl| gpl)?(?: as published by the free software foundation)?(?: either)? version (?P<version>\d(?:\.\d)?)(?: of the license)?(?P<later> or (?:at your option )?(?:any )?(?:later|newer))?"),
    ("gpl-short", r"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?(?P<kind>a|l)?gpl ?v?(?:version )?(?P<version>\d(?:\.\d)?)(?P<later>\+| or later| or any later)?"),
    ("gpl-name", r"(?:gnu )?(?P<kind>a|l)?gpl(?: ?v| version )(?P<version>[123](?:\.\d)?)(?P<later>\+| or later| or any later)?"),
    ("gpl-hope", r"distributed in the hope that it will be useful but without any warranty"),
    ("gpl-see", r"see the gnu (?:affero |lesser |library )?general public license for more details"),
    ("gpl-received", r"you should have received a copy of the gnu (?:affero |lesser |library )?general public license"),
    ("mpl-title", r"^mozilla public license version (?P<version>\d\.\d)(?: definitions| \d)?"),
    ("mpl-ref", r"(?:subject to the terms of|licen[sc]ed under|released under) the mozilla public license (?:mpl )?(?:version )?(?P<version>\d\.\d)"),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mit-ref", r"(?:licen[sc]ed|released|distributed|available|published|provided) under (?:either of )?(?:the )?(?:terms of the )?(?:mit|expat)(?: x11)? license"),
    ("mit-or", r"or (?:the )?(?:mit|expat) license"),
    ("mit-adjective", r"(?:is|are|be|was|code|project|software) (?:mit|expat) licensed"),
    ("bsd-ref", r"(?:licen[sc]ed|released|distributed|available|published) under (?:the |a )?(?:terms of the )?(?:(?P<clauses>[234]) clause |(?P<name>new|modified|simplified|original) )?bsd(?: (?P<after>[234]) clause)?(?: style)? license"),
    ("isc-ref", r"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?isc license"),
    ("boost-ref", r"(?:licen[sc]ed|distributed|released) under the boost software license version (?P<version>\d\.\d)"),
    ("eclipse-ref", r"eclipse public license (?:version )?(?P<version>\d\.\d)"),
    ("artistic-ref", r"(?:licen[sc]ed|distributed|released) under the artistic license (?:version )?(?P<version>\d\.\d)"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("unlicense-ref", r"(?:licen[sc]ed|released|distributed) under (?:the )?unlicense"),
    ("wtfpl", r"do what the fuck you want to public license"),
    ("cc0-ref", r"(?:cc0 ?1\.0|cc0 universal|cc0 public domain dedication|creative commons (?:cc0|zero)|(?:licen[sc]ed|released) under (?:the )?cc0)"),
    ("cc-ref", r"(?:licen[sc]ed|released|available|distributed|published) under (?:a |the )?(?:creative commons )?cc (?P<parts>by(?: nc)?(?: (?:sa|nd))?) (?P<version>\d\.\d)"),
    ("cc-long", r"creative commons (?P<parts>attribution(?: non ?commercial)?(?: (?:share ?alike|no ?deriv(?:ative)?s?(?: works)?))?) (?P<version>\d\.\d)"),
    ("domain", r"(?:is|are|placed|released|dedicated)(?: hereby)? (?:in|into|to) the public domain"),
    ("rights", r"all rights reserved"),
]

#: (licence, sequence of identifiers), the first that matches wins. "*": as its identifier says.
RULES = [
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "as-is", "no-event")),
    ("MIT", ("mit-grant", "mit-notice", "as-is", "no-event")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("ISC", ("isc-title", "isc-grant", "as-is")),
    ("ISC", ("isc-grant", "as-is")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-name", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-title", "bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-title", "bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("Zlib", ("zlib-as-is", "zlib-grant", "zlib-origin", "zlib-altered")),
    ("*", ("apache-title", "apache-grant", "apache-patent", "apache-ref", "apache-use", "apache-copy", "apache-as-is")),
    ("*", ("apache-title", "apache-grant", "apache-patent")),
    ("*", ("apache-ref", "apache-use", "apache-copy", "apache-as-is")),
    ("*", ("apache-ref", "apache-copy", "apache-as-is")),
    ("*", ("gpl-title", "gpl-ref", "gpl-hope", "gpl-see", "gpl-received")),
    ("*", ("gpl-ref", "gpl-hope", "gpl-see", "gpl-received")),
    ("*", ("gpl-ref", "gpl-hope", "gpl-see")),
    ("*", ("mpl-title", "mpl-ref", "mpl-copy")),
    ("*", ("mpl-ref", "mpl-copy")),
    ("*", ("spdx",)),
    ("*", ("gpl-title",)),
    ("*", ("apache-title",)),
    ("*", ("mpl-title",)),
    ("*", ("bsd-title",)),
    ("MIT", ("mit-title",)),
    ("ISC", ("isc-title",)),
    ("Zlib", ("zlib-title",)),
    ("*", ("apache-ref",)),
    ("*", ("apache-or",)),
    ("*", ("apache-name",)),
    ("*", ("apache-adjective",)),
    ("*", ("gpl-ref",)),
    ("*", ("gpl-short",)),
    ("*", ("gpl-name",)),
    ("*", ("mpl-ref",)),
    ("*", ("bsd-ref",)),
    ("*", ("boost-ref",)),
    ("*", ("eclipse-ref",)),
    ("*", ("artistic-ref",)),
    ("*", ("cc-ref",)),
    ("*", ("cc-long",)),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-or",)),
    ("MIT", ("mit-adjective",)),
    ("MIT", ("mit-grant",)),
    ("ISC", ("isc-ref",)),
    ("ISC", ("isc-grant",)),
    ("BSD", ("bsd-grant",)),
    ("Zlib", ("zlib-grant",)),
    ("Unlicense", ("unlicense",)),
    ("Unlicense", ("unlicense-ref",)),
    ("WTFPL", ("wtfpl",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("Public-Domain", ("domain",)),
]
SHORT = {
    "apache-ref": "Apache", "apache-or": "Apache", "apache-name": "Apache", "apache-title": "Apache",
    "apache-adjective": "Apache", "mpl-ref": "MPL", "mpl-title": "MPL",
    "boost-ref": "BSL", "eclipse-ref": "EPL", "artistic-ref": "Artistic",
}
KNOWN = [(name, re.compile(rf"(?<![a-z0-9]){pattern}(?![a-z0-9])")) for name, pattern in SENTENCES]
#: Sentences end at these, before white space; a blank line ends one as well.
CUT = re.compile(r"(?:[.!?:;]+[\"')\]]*(?=\s))|\n[ \t*#/;]*\n")
#: Names a licence expression outright; its identifier is "spdx".
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([\w.+\-()]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[\w.+\-()]+)*)")
#: Identifiers that stand by themselves, without that tag.
ID = (
    r"Apache-[12]\.\d|(?:A|L)?GPL-\d\.\d(?:-only|-or-later|\+)?|MPL-\d\.\d|EPL-\d\.\d|BSL-1\.0|BSD-[0234]-Clause"
    r"|CC0-1\.0|CC-BY(?:-NC)?(?:-SA|-ND)?-\d\.\d"
)
BARE = re.compile(rf"(?<![\w.\-/])(?:{ID})(?![\w\-+]|\.\w)")
#: A field of a manifest or a heading: names that are too short to stand by themselves.
LABEL = re.compile(rf"""\blicen[cs]e["']?[ \t]*[:=][ \t]*["']?(MIT|ISC|Zlib|Unlicense|WTFPL|{ID})(?![\w\-+]|\.\w)""", re.I)
VERSION = re.compile(r"\b(?:v|ver|vers)\.? ?(?=\d)")


@dataclass
class Match:
    licence: str
    start: int  # code points of the text, from the first to the last of its sentences
    end: int
    sentences: list[str]


def promising(low: str) -> bool:
    """False for a text in lower case that no known sentence is in."""
    return any(s in low for s in STEMS) or CC.search(low) is not None


def normalised(sentence: str) -> str:
    text = sentence.lower().replace("licence", "license")
    text = VERSION.sub("version ", text)
    text = re.sub(r"[^a-z0-9.+]+", " ", text)
    text = re.sub(r"\.(?!\d)|(?<!\d)\.|(?<!\w)\+", " ", text)
    return " ".join(text.split())


def named(identifier: str, g: dict[str, str | None]) -> str:
    """The licence that an identifier with its parts stands for, or "" if it names none."""
    v = g.get("version") or ""
    full = v if "." in v else f"{v}.0"
    if identifier in ("gpl-title", "gpl-ref", "gpl-short", "gpl-name"):
        kind = {"a": "A", "affero": "A", "l": "L", "lesser": "L", "library": "L"}.get((g.get("kind") or "").strip(), "")
        bare = "" if identifier in ("gpl-title", "gpl-name") else "-only"
        return f"{kind}GPL-{full}{'-or-later' if g.get('later') else bare}"
    if identifier in ("cc-ref", "cc-long"):
        words = re.sub(r"non ?commercial", "nc", g["parts"].replace("attribution", "by"))
        words = re.sub(r"share ?alike", "sa", words)
        words = re.sub(r"no ?deriv(?:ative)?s?(?: works)?", "nd", words)
        return f"CC-{'-'.join(words.upper().split())}-{v}"
    if identifier in ("bsd-ref", "bsd-title"):
        name = {"new": "3", "modified": "3", "simplified": "2", "original": "4"}.get(g.get("name") or "")
        clauses = g.get("clauses") or g.get("after") or name
        return f"BSD-{clauses}-Clause" if clauses else "BSD"
    return f"{SHORT[identifier]}-{full}" if identifier in SHORT else ""


def identified(text: str) -> list[tuple[str, str, int, int]]:
    """(identifier, licence it names or "", start, end) of the known sentences, in order.

    A sentence may hold several, taken from left to right without overlap.
    """
    out, upto = [], 0
    spans = [(m.start(), -m.end(), m.group(m.re.groups)) for p in (SPDX, LABEL, BARE) for m in p.finditer(text)]
    for at, end, name in sorted(spans):
        if at >= upto:
            out.append(("spdx", name, at, -end))
            upto = -end
    start = 0
    ends = [(m.start(), m.end()) for m in CUT.finditer(text)]
    for stop, then in [*ends, (len(text), len(text))]:
        sentence = text[start:stop]
        if promising(sentence.lower()):
            plain = normalised(sentence)
            hits = [(m.start(), -m.end(), k, name, m) for k, (name, p) in enumerate(KNOWN) for m in p.finditer(plain)]
            upto = 0
            for at, end, _, name, m in sorted(hits, key=lambda h: h[:3]):
                if at >= upto:
                    out.append((name, named(name, m.groupdict()), start, then))
                    upto = -end
        start = then
    return sorted(out, key=lambda f: f[2]) if out and out[0][0] == "spdx" else out


def scan(text: str | None) -> list[Match]:
    """Licences of a text, in order; "unknown" for licence sentences that no rule takes."""
    text = text or ""
    if not promising(text.lower()) and not BARE.search(text):
        return []
    found = identified(text)
    names = [f[0] for f in found]
    used = [False] * len(found)
    out = []
    for licence, sequence in RULES:
        n = len(sequence)
        for i in range(len(found) - n + 1):
            if tuple(names[i : i + n]) == sequence and not any(used[i : i + n]):
                used[i : i + n] = [True] * n
                name = licence
                if licence == "*":
                    name = next(f[1] for f in found[i : i + n] if f[1])
                out.append((i, Match(name, found[i][2], found[i + n - 1][3], list(sequence))))
    for i, f in enumerate(found):
        if not used[i] and f[0] != "rights":
            out.append((i, Match("unknown", f[2], f[3], [f[0]])))
    return [m for _, m in sorted(out, key=lambda x: x[0])]


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and matches (licence, start, end, sentences), a row per row of ``docs``.

    The whole text is read; null and empty texts have no matches. Offsets are
    code points. Repeated rows each get a row, an empty table none; other
    columns are not read.
    """
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    part = pa.struct(
        [("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sentences", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[vars(m) for m in scan(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(part))], ["doc_id", "matches"]
            )

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, matches array<struct<licence: string, start: bigint, end: bigint, sentences: array<string>>>",
    )
