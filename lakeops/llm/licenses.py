"""Licence scan with a positional index of rare words.

Each template is a licence notice.  The words of all templates get an inverse
document frequency; the ``RARE`` highest of each template are indexed with their
places.  A file's words are looked up in the index; each hit votes for the shift
between file and template, and the best window of shifts gives the share of a
template's rare words that stand in the template's layout.  From ``LEAST`` on, and
only where the template's key phrases stand in the aligned stretch, the template's
label is given.

Defined results: a null text is empty; no words give no labels and a score of 0;
repeated rows are treated alike; other columns are ignored; an empty table gives an
empty table.  Ties between windows go to the smallest shift.  The score is the best
share of any template that is verified; a base phrase alone scores 0.5.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RARE = 14
LEAST = 0.7
DRIFT = 4
BASE_SCORE = 0.5

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as licences give them, with the phrases that must stand in them.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted", "without restriction"),
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
        "apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
        "under the license is distributed on an as is basis without warranties or conditions of any kind",
        ("apache org licenses license 2 0",),
    ),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        ("redistribute it and or modify it", "gnu general public license"),
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution international license",
        ("creative commons attribution",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "retain the above copyright notice"),
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at http mozilla org mpl 2 0",
        ("mozilla public license v 2 0",),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee", "hereby granted"),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software", "public domain"),
    ),
)

_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return (text or "").encode().translate(_WORD).split()


@dataclass(frozen=True)
class Template:
    label: str
    n_rare: int
    length: int
    keys: tuple[tuple[bytes, ...], ...]


class Index:
    """Rare word -> ``(template, place)``, with what is needed to verify a template."""

    def __init__(self, templates=TEMPLATES, rare: int = RARE):
        lists = [words(text) for _, text, _ in templates]
        df = Counter(w for l in lists for w in set(l))
        idf = {w: math.log((1 + len(lists)) / n) for w, n in df.items()}
        self.templates: list[Template] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, (label, _, keys) in enumerate(templates):
            ranked = sorted(set(lists[t]), key=lambda w: (-idf[w], lists[t].index(w)))[:rare]
            for w in ranked:
                for place, x in enumerate(lists[t]):
                    if x == w:
                        self.postings[w].append((t, place))
            self.templates.append(Template(label, len(ranked), len(lists[t]), tuple(tuple(words(k)) for k in keys)))

    def labels(self, found: list[bytes], known: set[bytes], least: float = LEAST) -> dict[str, float]:
        """Label -> best share of its verified templates."""
        hits = known & self.postings.keys()
        per_template = Counter(t for w in hits for t in {t for t, _ in self.postings[w]})
        wanted = {t for t, n in per_template.items() if n >= least * self.templates[t].n_rare}
        if not wanted:
            return {}
        shifts: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for at, w in enumerate(found):
            if w in hits:
                for t, place in self.postings[w]:
                    if t in wanted:
                        shifts[t].append((at - place, w))
        out: dict[str, float] = {}
        for t, votes in shifts.items():
            template = self.templates[t]
            for share, shift in self._windows(sorted(votes), template, least):
                # longer files may insert words: the stretch reaches a little beyond the template on both sides
                stretch = found[max(0, shift - DRIFT) : shift + template.length + 2 * DRIFT]
                if share > out.get(template.label, 0.0) and all(_has(stretch, key) for key in template.keys):
                    out[template.label] = share
        return out

    @staticmethod
    def _windows(votes: list[tuple[int, bytes]], template: Template, least: float) -> Iterator[tuple[float, int]]:
        """Windows of shifts at most ``DRIFT`` wide that hold enough different rare words, with their share."""
        inside: Counter[bytes] = Counter()
        low = 0
        for high, (shift, w) in enumerate(votes):
            inside[w] += 1
            while shift - votes[low][0] > DRIFT:
                gone = votes[low][1]
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
                low += 1
            share = len(inside) / template.n_rare
            if share >= least:
                yield share, votes[low][0]


def _has(stretch: list[bytes], key: tuple[bytes, ...]) -> bool:
    return any(tuple(stretch[i : i + len(key)]) == key for i in range(len(stretch) - len(key) + 1))


_PHRASE_WORDS = tuple((tuple(words(p)), label) for p, label in PHRASES.items())


def phrase_places(found: list[bytes], known: set[bytes]) -> list[tuple[int, str]]:
    """``(first word, label)`` of every place where a base phrase stands."""
    out = []
    for phrase, label in _PHRASE_WORDS:
        if not known.issuperset(phrase):
            continue
        at = -1
        while True:
            try:
                at = found.index(phrase[0], at + 1)
            except ValueError:
                break
            if tuple(found[at : at + len(phrase)]) == phrase:
                out.append((at, label))
    return sorted(out)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, rare: int = RARE, least: float = LEAST
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, rare)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in batch.column("text").to_pylist():
                found = words(text)
                known = set(found)
                places = phrase_places(found, known)
                base = {label for _, label in places}
                more = index.labels(found, known, least)
                score = max([0.0, *more.values(), *([BASE_SCORE] if base else [])])
                row = (
                    len(found), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                    ",".join(sorted(base)), ",".join(sorted(base | more.keys())), score,
                )
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(
        scan,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double",
    )
