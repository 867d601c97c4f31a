"""License scans by a positional rare-token index.

Words are weighted by inverse document frequency over all documents, counted for the templates' vocabulary alone. For each
template, the file's RARE words of highest weight that the template has are looked up, and their postings are intersected by
relative position: place in the file minus place in the template is an alignment, and one that MATCHES of these words agree
on (give or take SHIFT places) is a candidate. A template counts if its mandatory key phrase stands there and the weighted
share of its words that stand at their places is high enough.
Base phrases are found at every place of their rarest word and compared word for word.

Defined results: a null or empty text has no words and no labels; repeated rows give repeated rows; texts of any length
are scanned in whole; words of equal weight are looked up in the order of their bytes; an empty table gives an empty one;
other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import importable, table

#: Fixed values of the query: phrase and label.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Label, template, mandatory key phrase. Short ones are the ways in which files name a licence, long ones are headers and grants.
TEMPLATES = [
    ("mit", "licensed under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and or distribute this software"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version", "gnu lesser general public license"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", "free and unencumbered software"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0"),
    ("reserved", "all rights reserved", "all rights reserved"),
]
#: Words of a template that are looked up in a file; how many of them must agree on an alignment; how far places may shift against
#: the template; least share.
RARE, MATCHES, SHIFT, MIN_SCORE = 4, 2, 2, 0.6

#: A-Z to a-z; all of ASCII but letters and digits to a space; bytes beyond ASCII stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def document_frequency(docs: DataFrame, vocabulary: list[bytes]) -> tuple[int, dict[bytes, int]]:
    """Documents in all, and for each word of the bounded ``vocabulary`` those that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, seen, n = frozenset(vocabulary), Counter(), 0
        for b in batches:
            for t in b.column(0).cast(pa.binary()).to_pylist():
                n += 1
                seen.update(vocab.intersection(words_of(t)))
        seen[b""] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["w", "n"])

    got = {bytes(r.w): r.n for r in docs.select("_text").mapInArrow(count, "w binary, n bigint").groupBy("w").agg(F.sum("n").alias("n")).collect()}
    return got.pop(b"", 0), got


class Index:
    """The templates, with the places of their words, rarest words first."""

    def __init__(self, phrases, templates, idf: dict[bytes, float], rare: int, matches: int, shift: int, min_score: float):
        self.rare, self.matches, self.shift, self.min_score, self.idf = rare, matches, shift, min_score, idf
        self.phrases = defaultdict(list)  # rarest word: (its place, words, label)
        for text, label in phrases:
            w = words_of(text.encode())
            at = max(range(len(w)), key=lambda i: (idf[w[i]], -i))
            self.phrases[w[at]].append((at, w, label))
        self.templates = []  # (label, words, key phrase, {word: places} by falling weight)
        for label, t, key in templates:
            w = words_of(t.encode())
            places = {x: [i for i, y in enumerate(w) if y == x] for x in sorted(set(w), key=lambda x: (-idf[x], x))}
            self.templates.append((label, w, words_of(key.encode()), places))
        self.wanted = frozenset(self.phrases).union(*(t[3] for t in self.templates))

    def alignments(self, at: dict[bytes, list[int]], places: dict[bytes, list[int]]) -> set[int]:
        """Alignments that enough of the file's rarest words of a template agree on."""
        found = [x for x in places if x in at][: self.rare]
        if len(found) < min(self.matches, len(places)):
            return set()
        offsets = [{p - q for p in at[x] for q in places[x]} for x in found]
        votes = Counter(o for some in offsets for o in {p + d for p in some for d in range(-self.shift, self.shift + 1)})
        return {o for some in offsets for o in some if votes[o] >= min(self.matches, len(places))}

    def scan(self, words: list[bytes]) -> tuple:
        starts, base, found, best = [], set(), set(), 0.0
        at: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            if w in self.wanted:
                at[w].append(p)
        for x, some in self.phrases.items():
            for p in at.get(x, ()):
                for i, phrase, label in some:
                    if p >= i and words[p - i : p - i + len(phrase)] == phrase:
                        starts.append(p - i)
                        base.add(label)
        for label, template, key, places in self.templates if at else ():
            if not all(x in at for x in key):
                continue
            whole = sum(self.idf[w] for w in template)
            for o in sorted(self.alignments(at, places)):
                lo = max(0, o - self.shift)
                near = words[lo : max(0, o + len(template) + self.shift)]
                if not any(near[i : i + len(key)] == key for i in range(len(near) - len(key) + 1)):
                    continue
                score = sum(self.idf[w] for i, w in enumerate(template) if w in near[max(0, i + o - self.shift - lo) : max(0, i + o + self.shift + 1 - lo)]) / whole
                best = max(best, score)
                if score >= self.min_score:
                    found.add(label)
        score = 1.0 if base else min(1.0, best)
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), score


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases=None, templates=None, rare: int = RARE, matches: int = MATCHES, shift: int = SHIFT, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for each row."""
    importable(docs.sparkSession)
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    vocabulary = sorted({w for t in [x for x, _ in phrases] + [x for _, *pair in templates for x in pair] for w in words_of(t.encode())})
    n, df = document_frequency(d, vocabulary)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 0.5)) + 1e-6 for w in vocabulary}
    index = Index(phrases, templates, idf, rare, matches, shift, min_score)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [index.scan(words_of(t)) for t in b.column(1).cast(pa.binary()).to_pylist()]
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, types))], names)

    kind = d.schema["_id"].dataType.simpleString()
    return d.mapInArrow(scan, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
