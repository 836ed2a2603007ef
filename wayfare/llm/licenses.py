"""Operator 1: licence scan with a positional rare-token index.

Templates are the headings and paragraphs of licences.  Their words' document frequencies are counted
over all documents, and the index holds the positions of each word in each template.
A file's licence words are ranked by that frequency: of every template whose key
phrases' words it has, it looks up the ``RARE`` rarest that stand in the file, so a
template is found by what this file has of it.  Every hit votes for a template at a
relative position, and a place where half of the words looked up agree is verified: all
key phrases of the template must stand where the place says, give or take ``SLACK``
words.  The score is the largest share of a template's words found in place.  A licence
line (``SPDX-License-Identifier``) gives the label of each identifier in its expression.

The three base phrases are templates whose words are all mandatory; every place
of theirs is found, for any such place holds the phrase's rarest word.

Null text counts as empty: no words, null first and last word, no labels, score
0.  An empty table gives an empty one.  Texts are read whole, however long.  Of equal
scores the value is the same; words of equal frequency rank by their bytes.  Repeated
rows are scanned once each; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import documents

#: Phrase and label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label, a paragraph or heading of the licence, its mandatory key phrases.
TEMPLATES = [
    ("mit", "the mit license", ["mit license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", ["permission is hereby granted", "without restriction"]),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ["this permission notice shall be included in all copies or substantial portions of the software"]),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", ["in no event shall the authors or copyright holders be liable for any claim damages or other liability"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ["you may not use this file except in compliance with the license"]),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", ["unless required by applicable law", "as is basis"]),
    ("bsd", "bsd license", ["bsd license"]),
    ("bsd", "bsd 2 clause license", ["bsd 2 clause"]),
    ("bsd", "bsd 3 clause license", ["bsd 3 clause"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use", "source and binary forms"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ["redistributions of source code must retain the above copyright notice"]),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ["redistributions in binary form must reproduce the above copyright notice"]),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["neither the name of", "may be used to endorse or promote products derived from this software"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ["attribution noncommercial"]),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ["attribution sharealike"]),
    ("cc0-1.0", "cc0 1 0 universal", ["cc0 1 0"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["gnu general public license", "either version 3"]),
    ("gpl-2.0", "gnu general public license version 2 june 1991", ["gnu general public license version 2"]),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ["gnu general public license", "either version 2"]),
    ("lgpl", "gnu lesser general public license", ["gnu lesser general public license"]),
    ("lgpl", "lgpl v3", ["lgpl v3"]),
    ("lgpl", "lgpl v2 1", ["lgpl v2 1"]),
    ("agpl-3.0", "gnu affero general public license version 3", ["gnu affero general public license"]),
    ("agpl-3.0", "agpl v3", ["agpl v3"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ["permission to use copy modify and or distribute this software", "with or without fee"]),
    ("isc", "isc license", ["isc license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software", "public domain"]),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", ["anyone is free to copy modify publish use compile sell or distribute this software"]),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ["eclipse public license"]),
    ("bsl-1.0", "boost software license version 1 0", ["boost software license"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ["provided as is without any express or implied warranty", "in no event will the authors be held liable"]),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", ["the origin of this software must not be misrepresented"]),
]
#: An identifier's words in a source file's licence line, and its label.
SPDX = {"mit": "mit", "apache 2 0": "apache-2.0", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "gpl 2 0": "gpl-2.0", "gpl 3 0": "gpl-3.0", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "agpl 3 0": "agpl-3.0", "mpl 2 0": "mpl-2.0", "isc": "isc", "unlicense": "unlicense", "epl 2 0": "epl-2.0", "zlib": "zlib", "cc0 1 0": "cc0-1.0", "bsl 1 0": "bsl-1.0"}
#: The licence line; what follows it is an expression of identifiers joined by the words of ``JOINS``.
LINE, JOINS = "spdx license identifier", (b"or", b"and", b"with")
#: An expression ends where so many words hold no further join.
STEP = 6
TEMPLATES += [("", LINE, [LINE])]
RARE, SLACK = 5, 2
#: A-Z lower-cased; separators become spaces; bytes from 0x80 up belong to words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places string"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


@dataclass
class Template:
    label: str
    words: list[bytes]
    keys: list[tuple[int, list[bytes]]]
    base: bool
    #: its words from rare to frequent, and those that a file must have
    ranked: list[bytes] = field(default_factory=list)
    must: set[bytes] = field(default_factory=set)


@dataclass
class Index:
    """Postings (template, word): its positions there."""

    templates: list[Template]
    postings: dict[tuple[int, bytes], list[int]] = field(default_factory=lambda: defaultdict(list))
    known: set[bytes] = field(default_factory=set)

    @classmethod
    def build(cls, frequency: dict[bytes, int]) -> Index:
        found = [Template(label, p.encode().split(), [(0, p.encode().split())], True) for p, label in BASE.items()]
        for label, text, keys in TEMPLATES:
            words = text.encode().split()
            at = lambda k, w=words: next(i for i in range(len(w)) if w[i : i + len(k)] == k)
            found.append(Template(label, words, [(at(k.encode().split()), k.encode().split()) for k in keys], False))
        index = cls(found)
        for t, template in enumerate(found):
            template.ranked = sorted(set(template.words), key=lambda w: (frequency.get(w, 0), w))
            template.must = {w for _, key in template.keys for w in key}
            for i, w in enumerate(template.words):
                index.postings[t, w].append(i)
            index.known.update(template.words)
        return index

    def rare_words(self, present: set[bytes]) -> dict[bytes, list[tuple[int, int]]]:
        """The places (template, position) of the rarest words that a file with the licence words ``present`` has of each template."""
        out: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, template in enumerate(self.templates):
            if template.must <= present:
                for w in [w for w in template.ranked if w in present][: 1 if template.base else RARE]:
                    out[w] += [(t, i) for i in self.postings[t, w]]
        return out

    def scan(self, words: list[bytes]) -> dict:
        votes: Counter[tuple[int, int]] = Counter()
        rare = self.rare_words(self.known & set(words))
        if rare:
            for i, w in enumerate(words):
                for t, j in rare.get(w, ()):
                    votes[t, i - j] += 1
        starts, base, labels, score, places = [], set(), set(), 0.0, []
        looked = Counter(t for places in rare.values() for t in {t for t, _ in places})
        for (t, at), _ in sorted(votes.items()):
            template = self.templates[t]
            if template.base:
                if at >= 0 and words[at : at + len(template.words)] == template.words:
                    starts.append(at)
                    base.add(template.label)
                    score = 1.0
            elif sum(votes.get((t, at + d), 0) for d in range(-SLACK, SLACK + 1)) * 2 >= looked[t] and all(self.stands(words, at + k, key) for k, key in template.keys):
                found = {template.label} if template.label else identifiers(words, max(at, 0))
                if not found:
                    continue
                labels |= found
                same = sum(0 <= at + i < len(words) and words[at + i] == w for i, w in enumerate(template.words))
                places += [f"{label}:{max(at, 0)}" for label in found]
                score = max(score, same / len(template.words))
        return {"n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None), "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | labels)), "score": score, "places": ",".join(sorted(set(places)))}

    @staticmethod
    def stands(words: list[bytes], at: int, key: list[bytes]) -> bool:
        return any(words[max(p, 0) : p + len(key)] == key for p in range(at - SLACK, at + SLACK + 1) if p >= 0)


def identifiers(words: list[bytes], at: int) -> set[str]:
    """The labels of the identifiers in the licence line near ``at``; unknown ones are passed over up to the next join."""
    line, out = LINE.encode().split(), set()
    starts = [p for p in range(max(at - SLACK, 0), at + SLACK + 1) if words[p : p + len(line)] == line]
    for p in starts:
        p += len(line)
        while True:
            for name, label in SPDX.items():
                if words[p : p + len(name.split())] == name.encode().split():
                    out.add(label)
            joins = [k for k in range(p, min(p + STEP, len(words))) if words[k] in JOINS]
            if not joins:
                break
            p = joins[0] + 1
    return out


def licence_words() -> list[str]:
    return sorted({w for text in [*BASE, *(t for _, t, _ in TEMPLATES)] for w in text.split()})


def document_frequencies(docs: DataFrame) -> dict[bytes, int]:
    """In how many documents each licence word stands; the table has one row per licence word."""
    known = {w.encode() for w in licence_words()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for b in batches:
            for text in b.column(0):
                seen.update(known.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r.word.encode(): r.n for r in rows}


def scan_licences(docs: DataFrame, frequency: dict[bytes, int] | None = None) -> DataFrame:
    index = Index.build(document_frequencies(docs) if frequency is None else frequency)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]
        for b in batches:
            found = [index.scan(words_of(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([f[n] for f in found], k) for n, k in zip(names, kinds, strict=True))], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(documents(spark, sf_dir))
