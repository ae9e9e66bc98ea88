"""License scans: normalised sentences are mapped to ids of known license sentences, whose sequences are matched against ordered rules."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from chronolith.llm.text import map_texts

#: Ids of license sentences and their wordings.
SENTENCES = {
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0. Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-2.0-may-not": "you may not use this file except in compliance with the License",
    "apache-2.0-obtain": "You may obtain a copy of the License at",
    "apache-2.0-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "mit-notice": "Released under the MIT License",
    "mit-notice-licensed": "Licensed under the MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-2.0-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-no-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-no-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0",
    "cc-by-4.0-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4.0-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-2.0-obtain": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "apache-2.0-copyright-grant": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form",
    "bsd-as-is-holders": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl-1.0-notice": "Distributed under the Boost Software License, Version 1.0",
    "bsl-1.0-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "unlicense-release": "This is free and unencumbered software released into the public domain",
    "unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "lgpl-2.1-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl-3.0-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl-no-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "agpl-3.0-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
}
#: Identifiers that an SPDX tag may name; each is a sentence of its own.
SPDX = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "Unlicense", "CC0-1.0", "MPL-2.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")
SENTENCES |= {f"{x.lower()}-spdx": f"SPDX-License-Identifier: {x}" for x in SPDX}
#: Ordered rules, each a sequence of sentence ids (others may stand between them) and the license it names.
RULES = (
    (("mit-grant", "mit-keep", "mit-as-is"), "MIT"),
    (("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-no-endorsement", "bsd-as-is-holders"), "BSD-3-Clause"),
    (("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-no-endorsement"), "BSD-3-Clause"),
    (("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is-holders"), "BSD-2-Clause"),
    (("bsd-redistribution", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("apache-2.0-notice", "apache-2.0-may-not", "apache-2.0-obtain", "apache-2.0-as-is"), "Apache-2.0"),
    (("apache-2.0-notice", "apache-2.0-as-is"), "Apache-2.0"),
    (("apache-2.0-may-not", "apache-2.0-as-is"), "Apache-2.0"),
    (("gpl-free", "gpl-no-warranty"), "GPL-3.0-or-later"),
    (("lgpl-3.0-free", "gpl-no-warranty"), "LGPL-3.0-or-later"),
    (("agpl-3.0-free", "gpl-no-warranty"), "AGPL-3.0-or-later"),
    (("lgpl-2.1-free", "lgpl-no-warranty"), "LGPL-2.1-or-later"),
    (("mpl-2.0-notice", "mpl-2.0-obtain"), "MPL-2.0"),
    (("isc-grant", "isc-as-is"), "ISC"),
    (("0bsd-grant", "isc-as-is"), "0BSD"),
    (("zlib-as-is", "zlib-grant"), "Zlib"),
    (("unlicense-release", "unlicense-grant"), "Unlicense"),
    (("gpl-2.0-free", "gpl-no-warranty"), "GPL-2.0-or-later"),
    (("apache-2.0-notice",), "Apache-2.0"),
    (("mit-notice",), "MIT"),
    (("mit-notice-licensed",), "MIT"),
    (("mit-grant",), "MIT"),
    (("gpl-3.0-notice",), "GPL-3.0-only"),
    (("gpl-free",), "GPL-3.0-or-later"),
    (("gpl-2.0-free",), "GPL-2.0-or-later"),
    (("cc-by-nc-4.0-notice",), "CC-BY-NC-4.0"),
    (("cc-by-nc-4.0-work",), "CC-BY-NC-4.0"),
    (("cc-by-sa-4.0-notice",), "CC-BY-SA-4.0"),
    (("cc-by-sa-4.0-work",), "CC-BY-SA-4.0"),
    (("cc-by-4.0-notice",), "CC-BY-4.0"),
    (("cc-by-4.0-work",), "CC-BY-4.0"),
    (("mpl-2.0-notice",), "MPL-2.0"),
    (("apache-2.0-copyright-grant",), "Apache-2.0"),
    (("isc-grant",), "ISC"),
    (("zlib-grant",), "Zlib"),
    (("bsl-1.0-notice",), "BSL-1.0"),
    (("bsl-1.0-grant",), "BSL-1.0"),
    (("unlicense-release",), "Unlicense"),
    (("lgpl-2.1-free",), "LGPL-2.1-or-later"),
    (("lgpl-3.0-free",), "LGPL-3.0-or-later"),
    (("agpl-3.0-free",), "AGPL-3.0-or-later"),
    (("epl-2.0-notice",), "EPL-2.0"),
    *(((f"{x.lower()}-spdx",), x) for x in SPDX),
)
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: Two ways to cut a text: sentences end at a stop, colon or semicolon before white space (but for an SPDX tag's colon and comment marks), or at a line without words; or also at each line's end.
_STOP = r"(?<!(?i:spdx-license-identifier:))(?<!\n[;:!])(?<!\n[;:!]{2})(?<=[.:;!?])(?=\s)"
_CUTS = (re.compile(rf"{_STOP}|\n[^\w\n]*(?=\n)|\Z"), re.compile(rf"{_STOP}|\n|\Z"))
#: An SPDX tag with the rest of its line, and the words of the license expression that follows it.
_TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I)
_TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", re.I)
#: Every known sentence has one of these, so a text without them has no known sentence.
TRIGGERS = ("licen", "permission", "redistribut", "copyright", "warrant", "free software", "public domain", "compiled binary", "mpl was not")


def normal(sentence: str) -> str:
    return " ".join(_WORD.findall(sentence.lower()))


def _parts(text: str, cut: re.Pattern[str]) -> list[tuple[str, int, int]]:
    """(normalised sentence, start, end) of each sentence with a word."""
    out, at = [], 0
    for m in cut.finditer(text):
        part = text[at : m.start()]
        if words := normal(part):
            out.append((words, at + len(part) - len(part.lstrip()), m.start()))
        at = m.end()
    return out


def _known() -> dict[str, str]:
    """Sentence -> id. A wording of several sentences counts by each that is long and no other wording's."""
    found: dict[str, set[str]] = {}
    for name, wording in SENTENCES.items():
        for words, _, _ in _parts(wording, _CUTS[0]):
            found.setdefault(words, set()).add(name)
    return {w: min(names) for w, names in found.items() if len(names) == 1 and len(w) > 20}


_BY_TEXT = _known()


def _tags(text: str) -> list[tuple[int, int, str]]:
    """(start, end, sentence id) of each known identifier in the license expressions of SPDX tags; the first one's span has the tag."""
    out = []
    for tag in _TAG.finditer(text):
        start, joined = tag.start(), True
        for term in _TERM.finditer(text, tag.start(1), tag.end()):
            if term[0].upper() in ("AND", "OR", "WITH"):
                joined, start = term[0].upper() != "WITH", -1  # an exception's name follows
            elif joined is None:
                break  # the expression is over
            else:
                if joined and (name := _BY_TEXT.get(normal(f"SPDX-License-Identifier: {term[0]}"))):
                    out.append((start if start >= 0 else term.start(), term.end(), name))
                joined = None
    return out


def sentences(text: str | None) -> list[tuple[str, int, int]]:
    """(sentence id, start, end) of each known sentence, in order, in code points; a run of one id counts once."""
    text = text or ""
    low = text.lower()
    if not any(t in low for t in TRIGGERS):
        return []
    hits = sorted([(a, b, _BY_TEXT[w]) for cut in _CUTS for w, a, b in _parts(text, cut) if w in _BY_TEXT] + _tags(text))
    out: list[tuple[str, int, int]] = []
    for a, b, name in hits:
        if out and out[-1][0] == name and (a < out[-1][2] or not text[out[-1][2] : a].strip()):
            out[-1] = (name, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((name, a, b))
    return out


def licenses(found: list[tuple[str, int, int]], gap: int | None = None) -> list[tuple[str, int, int]]:
    """(license, start, end): rules are tried in order; each takes its sentences where they follow in order, at most ``gap`` code points apart if it is given.

    One pass over the places of a rule's sentences: each takes the first unused one after the sentence before it, and a
    first sentence whose next one is too far leaves its place to the next first one.
    """
    places: dict[str, list[int]] = {}
    for i, (name, _, _) in enumerate(found):
        places.setdefault(name, []).append(i)
    out = []
    for rule, name in RULES:
        if any(x not in places for x in rule):
            continue
        used: list[set[int]] = [set() for _ in rule]
        at = [0] * len(rule)
        for first in places[rule[0]]:
            taken = [first]
            for k in range(1, len(rule)):
                own = places[rule[k]]
                while at[k] < len(own) and own[at[k]] <= taken[-1]:
                    at[k] += 1
                if at[k] == len(own) or gap is not None and found[own[at[k]]][1] - found[taken[-1]][2] > gap:
                    break
                taken.append(own[at[k]])
            if len(taken) == len(rule):
                out.append((name, found[taken[0]][1], found[taken[-1]][2]))
                for k, i in enumerate(taken):
                    used[k].add(i)
                for k in range(1, len(rule)):
                    at[k] += 1
        for k, x in enumerate(rule):
            if used[k]:
                places[x] = [i for i in places[x] if i not in used[k]]
                if not places[x]:
                    del places[x]
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def _row(doc_id, text: str | None, gap: int | None = None) -> tuple:
    found = sentences(text)
    named = licenses(found, gap)
    return doc_id, len(found), len(named), ",".join(sorted({n for n, _, _ in named})), ",".join(f"{n}:{a}:{b}" for n, a, b in named)


def license_scan(docs: DataFrame, gap: int | None = None) -> DataFrame:
    """doc_id, n_sentences, n_licenses, licenses (distinct, sorted), spans (license:start:end) for each row of ``docs``.

    Whatever stands between two sentences of a rule, it matches; with ``gap`` at most so many code points may. Null or empty
    text: nothing found. Long texts are read whole, in linear time. Ids may be null or repeated; columns other than doc_id and text are not read; an
    empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_sentences long, n_licenses long, licenses string, spans string"
    return map_texts(docs.select("doc_id", F.col("text").cast("string").alias("text")), lambda doc_id, text: _row(doc_id, text, gap), schema, "doc_id", "text")
