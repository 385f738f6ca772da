"""Licence recognition by sentences, after the sentence-rule method of German, Manabe and Inoue (2010).

A text is cut in sentences, each sentence normalised and looked up among known licence sentences. The text's
sequence of sentence identifiers is then matched against ordered rules: the first rule that fits names a licence
and uses up its sentences, and matching goes on with what is left.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.common import by_batch

#: Licence sentences as the licences and their usual notices word them, by identifier.
#: <any> stands for one to twelve words (names, years), <version> for a version number. Sentences that begin with
#: 'licensed under' or 'released under' may have a subject before ('This project is') and '(the "License")' behind.
SENTENCES: dict[str, str] = {
    "mit-named": "released under the MIT License",
    "mit-named-2": "this project is licensed under the terms of the MIT license",
    "mit-named-3": "licensed under the MIT license",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "no-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of <any> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-named": "licensed under the <version> clause BSD license",
    "bsd-named-2": "released under the <version> clause BSD license",
    "bsd-named-3": "licensed under the BSD <version> clause license",
    "bsd-named-4": "released under the BSD <version> clause license",
    "apache-named": "licensed under the Apache License, Version <version>",
    "apache-named-2": "released under the Apache License <version>",
    "apache-may-not": "you may not use this file except in compliance with the License",
    "apache-obtain": "You may obtain a copy of the License at <any>",
    "apache-obtain-2": "You may obtain a copy of the License at",
    "apache-basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl-named": "This work is licensed under the GNU General Public License, version <version>",
    "gpl-named-2": "licensed under the GNU General Public License version <version>",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version <version> of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-details": "See the GNU General Public License for more details",
    "lgpl-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version <version> of the License, or (at your option) any later version",
    "mpl-named": "This Source Code Form is subject to the terms of the Mozilla Public License, v <version>",
    "cc-named": "licensed under CC <any> <version>",
    "cc-named-2": "this work is licensed under a Creative Commons <any> <version> International License",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "spdx": "SPDX-License-Identifier: <any>",
}

#: Licence name and the identifiers that must follow each other in the text; earlier rules first.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("GPL-{version}-or-later", ("gpl-free", "gpl-hope", "gpl-details")),
    ("GPL-{version}-or-later", ("gpl-free",)),
    ("LGPL-{version}-or-later", ("lgpl-free",)),
    ("GPL-{version}", ("gpl-named",)),
    ("GPL-{version}", ("gpl-named-2",)),
    ("Apache-{version}", ("apache-named", "apache-may-not", "apache-obtain", "apache-basis")),
    ("Apache-{version}", ("apache-named", "apache-may-not", "apache-obtain-2", "apache-basis")),
    ("Apache-{version}", ("apache-named", "apache-may-not")),
    ("Apache-{version}", ("apache-named",)),
    ("Apache-{version}", ("apache-named-2",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-{version}-Clause", ("bsd-named",)),
    ("BSD-{version}-Clause", ("bsd-named-2",)),
    ("BSD-{version}-Clause", ("bsd-named-3",)),
    ("BSD-{version}-Clause", ("bsd-named-4",)),
    ("MIT", ("mit-grant", "mit-notice", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-named-2",)),
    ("MIT", ("mit-named-3",)),
    ("ISC", ("isc-grant", "as-is")),
    ("ISC", ("isc-grant",)),
    ("MPL-{version}", ("mpl-named",)),
    ("CC-{any}-{version}", ("cc-named",)),
    ("CC-{any}-{version}", ("cc-named-2",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
    ("SPDX:{any}", ("spdx",)),
)

#: One of these is in every sentence above; texts without any are not cut in sentences.
HINTS = ("licen", "permission", "redistribut", "software", "copyright", "warranty")

SENTENCE_END = re.compile(r"(?<=[.!?:;])\s+|\n\s*\n")
LINE_MARK = re.compile(r"(?m)^[ \t]*(?://|/?\*+/?|#+|;+|--|\d+\.|[-*])[ \t]+")
CLAUSE = re.compile(r"(?<=\d)-(?=clause)")
NAMED = ("licensed under ", "released under ")
#: Before and behind a sentence that names a licence; a subject that denies or supposes is none.
SUBJECT = r"(?!(?:\S+ ){0,12}?(?:no|not|nothing|none|neither|never|unless|if|whether) )(?:(?:\S+ ){1,12}?(?:is|are) )?"
TAIL = r"(?: the license)?"
WORD = re.compile(r"\w")
PUNCTUATION = re.compile(r"[^\w.+/\-]+")


def normalise(sentence: str) -> str:
    """Lower case, no punctuation but inside words, single spaces, British spelling folded."""
    words = PUNCTUATION.sub(" ", CLAUSE.sub(" ", sentence.lower().replace("licence", "license"))).split()
    return " ".join(w for w in (w.strip(".-/+") for w in words) if w)


def _compiled(sentences: Mapping[str, str]) -> tuple[dict[str, str], list[tuple[str, re.Pattern]]]:
    """Sentences without holes by their normal form; those with holes, and those that name a licence, as patterns."""
    exact, holes = {}, []
    for name, sentence in sentences.items():
        marked = sentence.replace("<any>", " holeany ").replace("<version>", " holeversion ")
        plain = normalise(marked)
        named = plain.startswith(NAMED)
        if "hole" not in plain:
            exact[plain] = name
            if not named:
                continue
        body = re.escape(plain).replace("holeany", r"(?P<any>\S+(?: \S+){0,11}?)").replace("holeversion", r"v?(?P<version>\d+(?:\.\d+)*)")
        holes.append((name, re.compile(SUBJECT + body + TAIL if named else body)))
    return exact, holes


class Recogniser:
    def __init__(self, sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> None:
        self.exact, self.holes = _compiled(sentences)
        # Known sentences with a colon or semicolon inside come in so many parts at most.
        self.parts = max(len(SENTENCE_END.split(s)) for s in sentences.values())
        self.rules = [(name, tuple(ids)) for name, ids in rules]

    def sentence(self, text: str) -> tuple[str, dict[str, str]] | None:
        plain = normalise(text)
        if plain in self.exact:
            return self.exact[plain], {}
        for name, pattern in self.holes:
            found = pattern.fullmatch(plain)
            if found:
                return name, {k: v.replace(" ", "-").upper() if k == "any" else v for k, v in found.groupdict().items() if v}
        return None

    def sentences(self, text: str) -> list[tuple[str, dict[str, str]]]:
        """Known sentences in order. A line may be a sentence by itself; else lines join until a sentence ends."""
        out, rest = [], []

        def flush() -> None:
            parts, at = SENTENCE_END.split(" ".join(rest)), 0
            while at < len(parts):
                # The longest run of parts that is a known sentence.
                for n in range(min(self.parts, len(parts) - at), 0, -1):
                    found = self.sentence(" ".join(parts[at : at + n]))
                    if found:
                        out.append(found)
                        break
                at += n
            rest.clear()

        for line in LINE_MARK.sub("", text).split("\n"):
            found = self.sentence(line) if any(h in line.lower() for h in HINTS) else None
            if found:
                flush()
                out.append(found)
            elif WORD.search(line):
                rest.append(line)
            else:
                flush()
        flush()
        return out

    def licences(self, text: str) -> tuple[list[str], list[str], list[str]]:
        """(licence names in text order, identifiers of all known sentences, identifiers that no rule used)."""
        known = self.sentences(text)
        ids = [name for name, _ in known]
        free, named = [True] * len(ids), []
        for name, wanted in self.rules:
            at = 0
            while True:
                picked = []
                for want in wanted:
                    at = next((i for i in range(picked[-1] + 1 if picked else 0, len(ids)) if free[i] and ids[i] == want), -1)
                    if at < 0:
                        break
                    picked.append(at)
                if len(picked) < len(wanted):
                    break
                holes: dict[str, str] = {}
                for i in picked:
                    free[i] = False
                    holes |= known[i][1]
                named.append((picked[0], name.format_map({"any": "", "version": "", **holes})))
        return [n for _, n in sorted(named)], ids, [i for i, f in zip(ids, free) if f]


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", recogniser: Recogniser | None = None) -> DataFrame:
    """(id, licenses, sentences, unmatched, status) of every row, in one pass without a shuffle.

    ``status``: 'licensed' (a rule fits), 'partial' (known sentences, no rule) or 'none'. NULL and empty texts are
    'none'. A rule's sentences may have others between them. Repeated rows give repeated rows; an empty table none.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    low = F.lower(text)
    hinted = F.lit(False)
    for hint in HINTS:
        hinted = hinted | low.contains(hint)
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.when(hinted, text).alias("text"))
    engine = recogniser or Recogniser()
    schema = T.StructType.fromDDL(
        "id bigint, licenses array<string>, sentences array<string>, unmatched array<string>, status string"
    )

    def make():
        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [engine.licences(t) if t else ([], [], []) for t in batch.column(1).to_pylist()]
            status = ["licensed" if a else "partial" if b else "none" for a, b, _ in found]
            lists = [pa.array([f[k] for f in found], pa.list_(pa.string())) for k in range(3)]
            return pa.RecordBatch.from_arrays([batch.column(0), *lists, pa.array(status, pa.string())], schema.names)

        return on

    return rows.mapInArrow(by_batch(make), schema)
