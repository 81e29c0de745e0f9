"""Licence scan by sentence rules.

A text is cut into fragments at sentence ends and line ends and normalised to
lower-case words. A known sentence may begin at any word, run over the ends of
fragments and be followed by anything; the longest one from a word is taken and
the search goes on behind it. Notices ("distributed under the terms of the MIT
License", SPDX lines, also with several licences) are made of leads and names.
The title of a licence has to be alone in its fragments. The identifiers, in the order of the text, are matched
against licence rules from the first rule to the last: a rule is a sequence of
identifiers that follow each other with at most ``GAP`` unknown fragments
between two of them. What a rule matches is used up, so a general rule does not
match again what a special one has taken.

Defined results: null and empty texts have no sentences and no licence;
repeated rows are scanned each by itself; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.shared import table

GAP = 2

# Known sentences, "*" stands for one word or more.
SENTENCES: dict[str, str] = {
    "apache-2-line": "licensed under the apache license version 2 0",
    "apache-2-line-released": "released under the apache license version 2 0",
    "apache-2-licensed": "licensed under the apache license version 2 0 the license",
    "apache-2-use": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "apache-2-url": "http www apache org licenses license 2 0",
    "apache-2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-line": "released under the mit license",
    "mit-line-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-short": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd-line": "released under the bsd license",
    "bsd-line-licensed": "licensed under the bsd license",
    "bsd-3-line": "licensed under the bsd 3 clause license",
    "bsd-2-line": "licensed under the bsd 2 clause license",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "gpl-3-line": "this work is licensed under the gnu general public license version 3",
    "gpl-2-line": "this work is licensed under the gnu general public license version 2",
    "gpl-3-line-short": "licensed under the gnu general public license version 3",
    "gpl-2-line-short": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version * of the license or at your option any later version",
    "gpl-free-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-free-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "lgpl-3-line": "licensed under the gnu lesser general public license version 3",
    "lgpl-2-1-line": "licensed under the gnu lesser general public license version 2 1",
    "agpl-3-line": "licensed under the gnu affero general public license version 3",
    "mpl-2-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "cc-by-nc-4-line": "licensed under cc by nc 4 0",
    "cc-by-4-line": "licensed under cc by 4 0",
    "cc-by-sa-4-line": "licensed under cc by sa 4 0",
    "cc-by-nd-4-line": "licensed under cc by nd 4 0",
    "cc-by-nc-sa-4-line": "licensed under cc by nc sa 4 0",
    "cc-by-nc-nd-4-line": "licensed under cc by nc nd 4 0",
    "cc-by-4-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-4-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0-long": "to the extent possible under law * has waived all copyright and related or neighboring rights to this work",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "all-rights": "all rights reserved",
}

# Rules in the order in which they are tried; special ones first.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache-2-licensed", "apache-2-use", "apache-2-copy", "apache-2-url", "apache-2-as-is", "apache-2-see"]),
    ("Apache-2.0", ["apache-2-licensed", "apache-2-use", "apache-2-copy"]),
    ("Apache-2.0", ["apache-2-as-is", "apache-2-see"]),
    ("Apache-2.0", ["apache-2-line"]),
    ("Apache-2.0", ["apache-2-line-released"]),
    ("Apache-2.0", ["apache-2-licensed"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-line"]),
    ("MIT", ["mit-line-licensed"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-3-line"]),
    ("BSD-2-Clause", ["bsd-2-line"]),
    ("BSD", ["bsd-line"]),
    ("BSD", ["bsd-line-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free-3", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl-free-2", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-free-3"]),
    ("GPL-2.0-or-later", ["gpl-free-2"]),
    ("GPL", ["gpl-free"]),
    ("GPL-3.0", ["gpl-3-line"]),
    ("GPL-2.0", ["gpl-2-line"]),
    ("GPL-3.0", ["gpl-3-line-short"]),
    ("GPL-2.0", ["gpl-2-line-short"]),
    ("LGPL-3.0", ["lgpl-3-line"]),
    ("LGPL-2.1", ["lgpl-2-1-line"]),
    ("AGPL-3.0", ["agpl-3-line"]),
    ("MPL-2.0", ["mpl-2-subject"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4-line"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd-4-line"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-line"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-line"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-long"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4-line"]),
    ("CC-BY-4.0", ["cc-by-4-line"]),
    ("CC-BY-4.0", ["cc-by-4-long"]),
    ("CC0-1.0", ["cc0-long"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("Unlicense", ["unlicense-free"]),
    ("MIT", ["mit-title"]),
    ("MIT", ["mit-title-short"]),
]

#: Names of licences in notices, and the sentence a notice with them stands for.
NAMES: dict[str, list[str]] = {
    "mit-line": ["mit", "mit license", "mit licence", "mit x11 license", "expat license"],
    "apache-2-line": [
        "apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache license version 2", "apache 2 0 license",
        "apache 2 license", "apache 2 0", "apache license v2", "apache software license version 2 0", "apache 2",
    ],
    "isc-line": ["isc", "isc license"],
    "bsd-line": ["bsd", "bsd license"],
    "bsd-3-line": ["bsd 3 clause", "bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"],
    "bsd-2-line": ["bsd 2 clause", "bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "mpl-2-line": ["mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v2 0", "mpl 2 0", "mpl v2 0"],
    "cc0-line": ["cc0", "cc0 1 0", "creative commons zero v1 0 universal"],
    "unlicense-line": ["unlicense"],
    **{
        f"{short}-{number.replace(' ', '-')}-{kind}line": [
            f"{name} {way}{after}"
            for name in (long, f"gnu {long}", short, f"gnu {short}")
            for way in (f"version {number}", f"v{number}", number, *([f"version {number} 0", f"v{number} 0", f"{number} 0"] if " " not in number else []))
            for after in afters
        ]
        + [f"{x}{short}v{number}{after}" for x in ("", "gnu ") for after in afters]
        for short, long, numbers in (
            ("gpl", "general public license", ("3", "2")),
            ("lgpl", "lesser general public license", ("3", "2 1")),
            ("agpl", "affero general public license", ("3",)),
        )
        for number in numbers
        for kind, afters in (("", ("", " only")), ("later-", (" or later", " or any later version", " or at your option any later version")))
    },
    **{
        f"cc-{kind}-4-line": [
            f"cc {kind.replace('-', ' ')} 4 0", f"creative commons {long} 4 0 international license", f"creative commons {long} 4 0 international",
            f"creative commons {long} 4 0", f"creative commons {long} 4 0 license",
        ]
        for kind, long in (
            ("by", "attribution"), ("by-sa", "attribution sharealike"), ("by-nc", "attribution noncommercial"),
            ("by-nd", "attribution noderivatives"), ("by-nc-sa", "attribution noncommercial sharealike"),
            ("by-nc-nd", "attribution noncommercial noderivatives"),
        )
    },
}
#: Identifiers of the SPDX list that are no name above.
SPDX: dict[str, list[str]] = {
    "unlicense-line": ["unlicense"],
    **{f"{x}-{n.replace(' ', '-')}-{k}line": [f"{x} {n}{a}" for a in e] for x, n in (("gpl", "3"), ("gpl", "2"), ("lgpl", "3"), ("lgpl", "2 1"), ("agpl", "3"))
       for k, e in (("", ("", " only") if " " in n else (" 0", " 0 only")), ("later-", (" or later",) if " " in n else (" 0 or later",)))},
}
for _name, _text, _licence in (
    ("isc-line", "licensed under the isc license", "ISC"),
    ("mpl-2-line", "licensed under the mozilla public license version 2 0", "MPL-2.0"),
    ("cc0-line", "licensed under cc0 1 0", "CC0-1.0"),
    ("unlicense-line", "licensed under the unlicense", "Unlicense"),
    ("gpl-3-later-line", "licensed under the gnu general public license version 3 or later", "GPL-3.0-or-later"),
    ("gpl-2-later-line", "licensed under the gnu general public license version 2 or later", "GPL-2.0-or-later"),
    ("lgpl-3-later-line", "licensed under the gnu lesser general public license version 3 or later", "LGPL-3.0-or-later"),
    ("lgpl-2-1-later-line", "licensed under the gnu lesser general public license version 2 1 or later", "LGPL-2.1-or-later"),
    ("agpl-3-later-line", "licensed under the gnu affero general public license version 3 or later", "AGPL-3.0-or-later"),
):
    SENTENCES[_name] = _text
    RULES.append((_licence, [_name]))
#: What stands before a name in a notice.
VERBS = ("licensed", "released", "distributed", "available", "provided", "published", "made available", "covered", "licenced", "redistributed")
LEADS = tuple(
    f"{verb} under {way}{article}"
    for verb in VERBS for way in ("", "the terms of ", "the conditions of ", "the terms and conditions of ") for article in ("", "the ", "a ", "an ")
)
#: Titles tell a licence only if nothing else is in their fragments; prose names licences too.
TITLES = frozenset({"mit-title", "mit-title-short"})

#: A text without any of these has none of the sentences and notices; checked when the table is built.
HINTS = (
    "licen", "permission", "redistribut", "warrant", "copyright", "software", "apache", "mpl", "rights",
    "as is", "liable", "under",
)

_FRAGMENT = re.compile(r"[.!?;:]+(?=\s|$)|[\r\n]+")
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _enter(root: dict, sentence: str, name: str) -> None:
    for word in sentence.split():
        root = root.setdefault(word, {})
    root.setdefault(None, name)


@lru_cache(maxsize=1)
def _trie() -> dict:
    """Known sentences and notices word by word; key None holds the identifier."""
    root: dict = {}
    for name, sentence in SENTENCES.items():
        if not any(x in sentence for x in HINTS):
            raise ValueError(f"no hint is in {name}")
        _enter(root, sentence, name)
    for leads, names in ((LEADS, NAMES), (("spdx license identifier",), NAMES), (("spdx license identifier",), SPDX)):
        for name, texts in names.items():
            for text in texts:
                for lead in leads:
                    if not any(x in lead for x in HINTS):
                        raise ValueError(f"no hint is in {lead}")
                    _enter(root, f"{lead} {text}", name)
    _enter(root, "the mit license mit", "mit-title")
    return root


@lru_cache(maxsize=1)
def _more() -> dict:
    """A further licence of a notice or an SPDX expression."""
    root: dict = {}
    for names in (NAMES, SPDX):
        for name, texts in names.items():
            for text in texts:
                for lead in ("or", "and", "or the", "and the"):
                    _enter(root, f"{lead} {text}", name)
    return root


def _step(nodes: list[tuple[dict, bool]], word: str) -> list[tuple[dict, bool]]:
    """All places in the trie after one more word; the flag tells that a star may take more."""
    found = []
    for node, star in nodes:
        if word in node:
            found.append((node[word], False))
        if "*" in node:
            found.append((node["*"], True))
        if star:
            found.append((node, True))
    return found


def sentence_ids(text: str | None) -> list[tuple[int, str]]:
    """(number of its first fragment, identifier) of the known sentences of a text, in order."""
    if not text:
        return []
    low = text.lower()
    if not any(x in low for x in HINTS):
        return []
    fragments = [x for x in map(words, _FRAGMENT.split(text)) if x]
    every = [word for x in fragments for word in x]
    owner = [i for i, x in enumerate(fragments) for _ in x]
    root, found, at, after = _trie(), [], 0, None
    while at < len(every):
        best = None
        if after == at:
            best = _longest(_more(), every, at)
        if best is None and every[at] in root:
            best = _longest(root, every, at)
            if best and best[1] in TITLES:
                end = best[0]
                whole = (at == 0 or owner[at - 1] != owner[at]) and (end == len(every) or owner[end] != owner[end - 1])
                best = best if whole else None
        if best:
            found.append((owner[at], best[1]))
            at = best[0]
            after = at if best[1] in NAMES or best[1] in SPDX else None
        else:
            at += 1
    return found


def _longest(root: dict, every: list[str], at: int) -> tuple[int, str] | None:
    """End and identifier of the longest sentence that begins at a word; a star takes as little as it can."""
    nodes, best = [(root, False)], None
    while at < len(every) and nodes:
        nodes = _step(nodes, every[at])
        at += 1
        # Words for words goes before a star.
        names = [node[None] for node, star in nodes if None in node and not star]
        if names:
            best = at, names[0]
            nodes = [x for x in nodes if not x[1]]
    return best


def licences_of(found: list[tuple[int, str]], gap: int = GAP) -> list[str]:
    """Licences of identifiers by the ordered rules, in the order of the text."""
    if not found:
        return []
    used: set[int] = set()
    matched: list[tuple[int, str]] = []
    present = {name for _, name in found}
    for licence, rule in RULES:
        if not present.issuperset(rule):
            continue
        for start in range(len(found) - len(rule) + 1):
            run = range(start, start + len(rule))
            if any(found[i][1] != name or i in used for i, name in zip(run, rule, strict=True)):
                continue
            if any(found[i + 1][0] - found[i][0] > gap + _fragments(found[i][1]) for i in run[:-1]):
                continue
            used.update(run)
            matched.append((start, licence))
    return list(dict.fromkeys(licence for _, licence in sorted(matched)))


@lru_cache(maxsize=None)
def _fragments(name: str) -> int:
    """Fragments a sentence may be wrapped into: about one for six words."""
    return 1 + len(SENTENCES[name].split()) // 6


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = pa.list_(pa.string())
    for batch in batches:
        found = [sentence_ids(x.as_py()) for x in batch[1]]
        yield pa.record_batch(
            [batch[0], pa.array([licences_of(x) for x in found], names), pa.array([[n for _, n in x] for x in found], names)],
            names=["doc_id", "licences", "sentence_ids"],
        )


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, licences, sentence_ids) of every document."""
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_scan, "doc_id long, licences array<string>, sentence_ids array<string>")


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.array_join("licences", "|").alias("licences"),
        F.array_join("sentence_ids", "|").alias("sentence_ids"),
        (F.size("licences") > 0).alias("licensed"),
    )
