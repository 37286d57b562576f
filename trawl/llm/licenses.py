"""License notices found by a positional index of rare words.

Templates are the notices listed below.  Words of all templates make a small
index: word -> (template, position).  How many texts of the corpus hold each
of these words is counted over all texts.  Of a text's own license words those
of highest inverse document frequency are looked up, down to ``ANCHORS`` for
each template whose mandatory words the text has, so that a notice is not lost
beside another one or with a rare word left out.  Each place of such a word
votes for where a template would begin; votes that agree on a beginning, give
or take ``SLACK`` words, make a candidate.  It becomes a label when the
template's mandatory phrases stand there word by word.

Phrases that stand anywhere (``BASE``) label a text by themselves.

Words are runs of ASCII letters and digits and of anything outside ASCII;
A-Z are lower-cased.  Texts are read whole, whatever their length; a very long one takes its
task memory in proportion.  Null and empty texts have no words, no label and score
0.  Repeated rows are scanned each for itself; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.batches import filled, narrowed, per_text, slices

# Phrases that label a text wherever they stand.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# License notices as published, lower case, with their mandatory phrases.
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    ("mit", "released under the mit license", ("the mit license",)),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license",
        ("licensed under the apache license version 2", "in compliance with the license"),
    ),
    ("apache-2", "licensed under the apache license version 2 0", ("the apache license version 2",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    (
        "gpl-3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
        ("gnu general public license", "either version 3 of the license"),
    ),
    (
        "bsd-3",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms", "the following conditions are met"),
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    (
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial",),
    ),
    ("reserved", "all rights reserved", ("all rights reserved",)),
    (
        "gpl-2",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 2 of the license or at your option any later version",
        ("gnu general public license", "either version 2 of the license"),
    ),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    (
        "lgpl-2.1",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation either version 2 1 of the license or at your option any later version",
        ("gnu lesser general public license", "either version 2 1 of the license"),
    ),
    (
        "lgpl-3",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version",
        ("gnu lesser general public license", "either version 3 of the license"),
    ),
    (
        "agpl-3",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version",
        ("gnu affero general public license", "either version 3 of the license"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify and or distribute this software", "this permission notice appear in all copies"),
    ),
    (
        "epl-2",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
        ("eclipse public license 2 0",),
    ),
    (
        "epl-2",
        "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0",
        ("eclipse public license v 2 0",),
    ),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    (
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    (
        "cc-by-nd",
        "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
        ("creative commons attribution noderivatives",),
    ),
    (
        "cc0",
        "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide",
        ("copyright and related and neighboring rights", "to the public domain worldwide"),
    ),
    ("cc0", "creative commons zero v1 0 universal", ("creative commons zero",)),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software released into the public domain",),
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software",
        ("in no event will the authors be held liable for any damages arising from the use of this software",),
    ),
    (
        "bsl-1",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license",
        ("to any person or organization obtaining a copy of the software", "covered by this license"),
    ),
    ("bsl-1", "distributed under the boost software license version 1 0", ("boost software license version 1 0",)),
)
#: Distinct words of a text by which a template is looked up, rarest first.
ANCHORS = 5
#: Share of a template's anchors that must agree on a beginning.
AGREE = 0.6
#: Words by which places may be shifted against each other.
SLACK = 3

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(b if b in _KEPT else 0x20 for b in range(256)).lower()


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def _places(joined: bytes, phrase: str) -> Iterator[int]:
    """First words (from 0) of all places of ``phrase``; words are joined and
    surrounded by single blanks."""
    wanted = b" " + phrase.encode() + b" "
    at, counted, word = joined.find(wanted), 0, -1
    while at >= 0:
        word += joined.count(b" ", counted, at + 1)
        counted = at + 1
        yield word
        at = joined.find(wanted, at + 1)


class Index:
    """Positional postings of all template words, and how rare they are."""

    def __init__(self, frequency: dict[bytes, int], texts: int):
        self.templates = [(label, t.encode().split(), phrases) for label, t, phrases in TEMPLATES]
        self.counts = [Counter(words) for _, words, _ in self.templates]
        self.needed = [{w for p in phrases for w in p.encode().split()} for _, _, phrases in self.templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, words, _) in enumerate(self.templates):
            for position, word in enumerate(words):
                self.postings[word].append((number, position))
        rarity = {w: log((texts + 1) / (frequency.get(w, 0) + 1)) for w in self.postings}
        self.rank = {w: place for place, w in enumerate(sorted(rarity, key=lambda w: (-rarity[w], w)))}

    def scan(self, words: list[bytes], joined: bytes) -> dict[str, float]:
        """Label -> best share of a template's words found in place."""
        present = self.postings.keys() & words
        open_templates = [n for n, needed in enumerate(self.needed) if needed <= present]
        if not open_templates:
            return {}
        # the text's rarest license words, each for the templates that still lack anchors
        anchors = dict.fromkeys(open_templates, 0)
        asked: dict[bytes, list[tuple[int, int]]] = {}
        for word in sorted(present, key=self.rank.__getitem__):
            takers = {n for n, _ in self.postings[word] if anchors.get(n, ANCHORS) < ANCHORS}
            if takers:
                asked[word] = [x for x in self.postings[word] if x[0] in takers]
                for number in takers:
                    anchors[number] += 1
        votes: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for at, word in enumerate(words):
            for number, position in asked.get(word, ()):
                votes[number].append((at - position, word))
        found: dict[str, float] = {}
        for number, cast in votes.items():
            label, template, phrases = self.templates[number]
            cast.sort()
            inside: Counter[bytes] = Counter()
            first = 0
            stated = None
            for beginning, word in cast:
                inside[word] += 1
                while cast[first][0] < beginning - SLACK:
                    gone = cast[first][1]
                    inside[gone] -= 1
                    if not inside[gone]:
                        del inside[gone]
                    first += 1
                if len(inside) < AGREE * anchors[number]:
                    continue
                if stated is None:
                    stated = [list(_places(joined, p)) for p in phrases]
                    if not all(stated):
                        break
                low, high = cast[first][0] - SLACK, beginning + len(template) + SLACK
                # places are in order
                if all((at := bisect_left(places, low)) < len(places) and places[at] < high for places in stated):
                    here = Counter(words[max(0, low) : high])
                    share = sum((here & self.counts[number]).values()) / len(template)
                    found[label] = max(found.get(label, 0.0), share)
        return found


def frequencies(rows: DataFrame, text_column: str = "text") -> tuple[dict[bytes, int], int]:
    """Texts that hold each template word, and the number of texts; the result
    is bounded by the templates' vocabulary."""
    wanted = {w for _, t, _ in TEMPLATES for w in t.encode().split()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for piece in slices(batches):
            texts = filled(piece.column("text"))
            seen[b""] += len(texts)
            for text in texts:
                seen.update(wanted.intersection(words_of(text)))
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([w.decode() for w in seen], pa.string()), "n": pa.array(list(seen.values()), pa.int64())
        })

    table = rows.select(rows[text_column].cast("string").alias("text")).mapInArrow(count, "word string, n long")
    found = {w.encode(): n for w, n in table.groupBy("word").agg(F.sum("n")).collect()}
    return found, found.pop(b"", 0)


SCHEMA = (
    "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def scan_licenses(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row; score is the best share of a template in place, 1 for a base phrase."""
    index = frequencies(rows, text_column)

    def work(batch: pa.RecordBatch) -> dict:
        known = Index(*index)
        out: dict[str, list] = {name.split()[0]: [] for name in SCHEMA.split(", ")[1:]}
        for text in filled(batch.column("text")):
            words = words_of(text)
            base: list[int] = []
            base_labels = set()
            joined = b" " + b" ".join(words) + b" "
            for phrase, label in BASE:
                places = list(_places(joined, phrase))
                base += places
                base_labels |= {label} if places else set()
            found = known.scan(words, joined)
            out["n_words"].append(len(words))
            out["n_base"].append(len(base))
            out["first_word"].append(min(base, default=None))
            out["last_word"].append(max(base, default=None))
            out["base_labels"].append(",".join(sorted(base_labels)))
            out["labels"].append(",".join(sorted(base_labels | set(found))))
            out["score"].append(1.0 if base else max(found.values(), default=0.0))
        for name in ("first_word", "last_word"):
            out[name] = pa.array(out[name], pa.int64())
        return {"id": batch.column("id")} | out

    return per_text(narrowed(rows, id_column, text_column), work, SCHEMA)
