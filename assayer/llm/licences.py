"""Licence scans by sentence rules.

A text is split into sentences, a sentence is normalised, and a known one is replaced by its
identifier. Rules are ordered: each is a sequence of identifiers, and the rules tried first are the longer and
more specific ones; what a rule has matched is not matched again by a later rule. All of it is DataFrame
operations without a shuffle; sentences and rules are parameters of a fixed size.

The table has the notices and warranty paragraphs of the common licences in their usual wording; short notices, Creative Commons
licences and SPDX lines are built from names. Whole licence bodies beyond the sentences below are not in it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Well-known sentences of public licences and notices, by identifier.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-notice-the": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,',
    "apache-spdx": "SPDX-License-Identifier: Apache-2.0",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-spdx": "SPDX-License-Identifier: MIT",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "gpl3-spdx": "SPDX-License-Identifier: GPL-3.0-only",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-full": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-full": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "rights": "All rights reserved.",
    "apache-conditions": "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-language": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit0-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.',
    "bsd-warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "bsd-liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-warranty": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "isc-liability": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "gpl2-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl-received": "You should have received a copy of the GNU General Public License along with this program.",
    "lgpl21-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl-details": "See the GNU Lesser General Public License for more details.",
    "lgpl3-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-details": "See the GNU Affero General Public License for more details.",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense-public": "This is free and unencumbered software released into the public domain.",
    "unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "cc0-title": "CC0 1.0 Universal",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}

# Names in short notices, Creative Commons licences, and SPDX identifiers.
NAMES = {
    "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "BSL-1.0": "Boost Software License 1.0",
    "EPL-2.0": "Eclipse Public License 2.0", "GPL-2.0-only": "GNU General Public License v2.0", "GPL-3.0-only": "GNU General Public License v3.0",
    "ISC": "ISC License", "MIT": "MIT License", "MPL-2.0": "Mozilla Public License 2.0", "Unlicense": "Unlicense", "Zlib": "zlib License",
}
CREATIVE_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = {"3.0": "Unported", "4.0": "International"}
SPDX = (
    "0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 BUSL-1.1 "
    "CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 "
    "ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3-or-later GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only "
    "LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PostgreSQL "
    "PSF-2.0 Unlicense UPL-1.0 W3C WTFPL Zlib"
).split()


def _built() -> dict[str, tuple[str, str]]:
    """The sentences that follow from names alone: identifier to (licence, sentence)."""
    built = {}
    for licence, name in NAMES.items():
        for verb in ("Licensed", "Released", "Distributed"):
            built[f"{verb.lower()}-{licence}"] = licence, f"{verb} under the {name}."
    for code, name in CREATIVE_COMMONS.items():
        for version, place in CC_VERSIONS.items():
            licence = f"CC-{code}-{version}"
            built[f"short-{licence}"] = licence, f"Licensed under CC {code} {version}."
            built[f"full-{licence}"] = licence, f"This work is licensed under a Creative Commons {name} {version} {place} License."
    for licence in SPDX:
        built[f"spdx-{licence}"] = licence, f"SPDX-License-Identifier: {licence}"
    return built


def plain(sentence: str) -> str:
    """What is left of a sentence: ASCII letters and digits in lower case, with single spaces between."""
    out = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence)
    return " ".join(out.lower().split())


_SPELLED = {plain(text) for text in SENTENCES.values()}
_BUILT = {name: pair for name, pair in _built().items() if plain(pair[1]) not in _SPELLED}
SENTENCES |= {name: text for name, (_, text) in _BUILT.items()}


@dataclass(frozen=True)
class LicenceRule:
    licence: str
    sentences: tuple[str, ...]


# In the order in which they are tried.
RULES = (
    LicenceRule("GPL-3.0-or-later", ("gpl-free", "gpl-warranty", "gpl-details", "gpl-received")),
    LicenceRule("GPL-3.0-or-later", ("gpl-free", "gpl-warranty", "gpl-details")),
    LicenceRule("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty", "gpl-details", "gpl-received")),
    LicenceRule("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty", "gpl-details")),
    LicenceRule("GPL-2.0-only", ("gpl2-only", "gpl-warranty", "gpl-details")),
    LicenceRule("LGPL-2.1-or-later", ("lgpl21-later", "lgpl-warranty", "lgpl-details")),
    LicenceRule("LGPL-3.0-or-later", ("lgpl3-later", "gpl-warranty", "lgpl-details")),
    LicenceRule("AGPL-3.0-or-later", ("agpl3-later", "gpl-warranty", "agpl-details")),
    LicenceRule("Apache-2.0", ("apache-notice-the", "apache-comply", "apache-copy", "apache-as-is", "apache-conditions", "apache-language")),
    LicenceRule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty", "bsd-liability")),
    LicenceRule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability")),
    LicenceRule("MIT", ("mit-grant", "mit-condition", "mit-warranty", "mit-liability")),
    LicenceRule("MIT-0", ("mit0-grant", "mit-warranty", "mit-liability")),
    LicenceRule("ISC", ("isc-grant", "isc-warranty", "isc-liability")),
    LicenceRule("0BSD", ("0bsd-grant", "isc-warranty", "isc-liability")),
    LicenceRule("MPL-2.0", ("mpl-notice", "mpl-copy")),
    LicenceRule("Unlicense", ("unlicense-public", "unlicense-grant")),
    LicenceRule("Zlib", ("zlib-warranty", "zlib-grant")),
    LicenceRule("Apache-2.0", ("apache-notice-the", "apache-comply", "apache-copy", "apache-as-is")),
    LicenceRule("Apache-2.0", ("apache-notice-the", "apache-comply")),
    LicenceRule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    LicenceRule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    LicenceRule("MIT", ("mit-grant", "mit-condition")),
    LicenceRule("Apache-2.0", ("apache-notice",)),
    LicenceRule("Apache-2.0", ("apache-notice-the",)),
    LicenceRule("Apache-2.0", ("apache-spdx",)),
    LicenceRule("MIT", ("mit-notice",)),
    LicenceRule("MIT", ("mit-licensed",)),
    LicenceRule("MIT", ("mit-grant",)),
    LicenceRule("MIT", ("mit-spdx",)),
    LicenceRule("GPL-3.0-only", ("gpl3-notice",)),
    LicenceRule("GPL-3.0-only", ("gpl3-spdx",)),
    LicenceRule("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    LicenceRule("CC-BY-NC-4.0", ("cc-by-nc-full",)),
    LicenceRule("CC-BY-4.0", ("cc-by-notice",)),
    LicenceRule("CC-BY-4.0", ("cc-by-full",)),
    LicenceRule("GPL-3.0-or-later", ("gpl-free",)),
    LicenceRule("proprietary", ("rights",)),
    LicenceRule("GPL-2.0-or-later", ("gpl2-later",)),
    LicenceRule("GPL-2.0-only", ("gpl2-only",)),
    LicenceRule("LGPL-2.1-or-later", ("lgpl21-later",)),
    LicenceRule("LGPL-3.0-or-later", ("lgpl3-later",)),
    LicenceRule("AGPL-3.0-or-later", ("agpl3-later",)),
    LicenceRule("MIT-0", ("mit0-grant",)),
    LicenceRule("ISC", ("isc-grant",)),
    LicenceRule("0BSD", ("0bsd-grant",)),
    LicenceRule("MPL-2.0", ("mpl-notice",)),
    LicenceRule("Unlicense", ("unlicense-public",)),
    LicenceRule("CC0-1.0", ("cc0-waiver",)),
    LicenceRule("CC0-1.0", ("cc0-title",)),
    LicenceRule("BSL-1.0", ("boost-notice",)),
    LicenceRule("Zlib", ("zlib-grant",)),
    *(LicenceRule(licence, (name,)) for name, (licence, _) in _BUILT.items()),
)

# A sentence ends with its line, or after . ! ? : ; , if space follows.
_ENDS = r"[\n\r]+|(?<=[.!?:;,])[\x20\t]+"


def _normal(part: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(part), "[^a-z0-9]+", " "))


def known_sentences(sentences: dict[str, str]) -> dict[str, str]:
    known = {plain(text): name for name, text in sentences.items()}
    if len(known) < len(sentences) or any("," in name or not key for key, name in known.items()):
        raise ValueError("sentences must differ when normalised, and identifiers hold no comma")
    return known


def identified(text: Column, sentences: dict[str, str]) -> Column:
    """The identifiers of the known sentences of a text, in the order of the text.

    Texts are wrapped anywhere and sentences hold commas, so a sentence may be in several parts. Candidates are the
    runs of parts that start at one that begins like a known sentence, and have no more parts than that has words;
    the longest known run counts, and the parts that it covers are passed over.
    """
    known = known_sentences(sentences)
    parts = max(len(key.split()) for key in known)
    table = F.create_map(*[F.lit(x) for item in known.items() for x in item])
    ones = F.array(*[F.lit(x) for x in sorted({key.split()[0] for key in known})])
    twos = F.array(*[F.lit(x) for x in sorted({" ".join(key.split()[:2]) for key in known})])

    def begins(unit: Column) -> Column:
        return F.array_contains(F.when(F.contains(unit, F.lit(" ")), twos).otherwise(ones), F.substring_index(unit, " ", 2))

    def match(units: Column) -> Column:
        def at(i: Column) -> Column:
            sizes = F.sequence(F.least(F.lit(parts), F.size(units) - i), F.lit(1), F.lit(-1))
            run = lambda n: F.struct(table[F.array_join(F.slice(units, i + 1, n), " ")].alias("id"), n.alias("n"))
            hit = F.get(F.filter(F.transform(sizes, run), lambda r: r["id"].isNotNull()), F.lit(0))
            return F.when(begins(F.get(units, i)), hit)

        zero = F.struct(F.lit(0).alias("free"), F.array().cast("array<string>").alias("ids"))

        def step(a: Column, i: Column) -> Column:
            def use(hit: Column) -> Column:
                took = F.struct((i + hit["n"]).alias("free"), F.concat(a["ids"], F.array(hit["id"])).alias("ids"))
                return F.when((i >= a["free"]) & hit["id"].isNotNull(), took).otherwise(a)

            return F.get(F.transform(F.array(at(i)), use), F.lit(0))

        some = F.exists(units, begins)
        numbers = F.sequence(F.lit(0), F.size(units) - 1)
        return F.when(some, F.aggregate(numbers, zero, step, lambda a: a["ids"])).otherwise(F.array().cast("array<string>"))

    units = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), _ENDS, -1), _normal), lambda u: u != "")
    return F.get(F.transform(F.array(units), match), F.lit(0))


def matched(ids: Column, rules: Sequence[LicenceRule]) -> tuple[Column, Column]:
    """The licences of the rules that match, and the identifiers that no rule has used.

    The sequence is held as text, `,a,,b,`; a rule removes its occurrences, leaving a mark, so that
    sentences that were apart do not become neighbours. The rules of one sentence at the end of the list cannot take anything
    from each other, so these are one lookup.
    """
    ordered = list(rules)
    single: dict[str, str] = {}
    while ordered and len(ordered[-1].sentences) == 1:
        last = ordered.pop()
        single[last.sentences[0]] = last.licence
    rest = F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(","))
    used = []
    for rule in ordered:
        sequence = F.lit("".join(f",{name}," for name in rule.sentences))
        used.append(F.when(F.contains(rest, sequence), F.lit(rule.licence)))
        rest = F.replace(rest, sequence, F.lit("/"))
    none = F.array().cast("array<string>")
    left = F.filter(F.split(F.translate(rest, "/", ","), ","), lambda x: x != "")
    if not single:
        return F.array(*used) if used else none, left
    table = F.create_map(*[F.lit(x) for item in single.items() for x in item])
    looked_up = F.transform(left, lambda x: table[x])
    return F.concat(F.array(*used) if used else none, looked_up), F.filter(left, lambda x: table[x].isNull())


def scan(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", sentences: dict[str, str] = SENTENCES, rules: Sequence[LicenceRule] = RULES) -> DataFrame:
    """(keep.., sentences, licences, unmatched): identifiers found, licences by rule, sentences left over.

    Licences are sorted and listed once. NULL and empty texts hold no sentence; every row is kept as it is,
    repeated ones included; an empty table gives an empty table; other columns are not read.
    """
    named = {name for rule in rules for name in rule.sentences}
    if missing := named - set(sentences):
        raise ValueError(f"rules name unknown sentences: {sorted(missing)}")
    found = docs.select(*keep, identified(F.col(text), sentences).alias("sentences"))
    licences, unused = matched(F.col("sentences"), rules)
    none = F.array().cast("array<string>")
    some = F.size("sentences") > 0
    every = F.when(some, F.array_sort(F.array_distinct(F.filter(licences, lambda x: x.isNotNull())))).otherwise(none)
    left = F.when(some, unused).otherwise(none)
    return found.select(*keep, "sentences", every.alias("licences"), left.alias("unmatched"))
