"""Licence scan by a positional index of rare words.

Templates are notices and texts of licences; square brackets mark their mandatory key phrases.
One pass over the files keeps the places of licence words (words of any template), nothing else
of a text. How rare each of them is (IDF) is counted over all files. The index holds, for every
template, the places of the rarest of its mandatory words; a file's rarest licence words are
looked up there, and their postings are intersected by relative position: all of a template's
rare words have to stand in the file at about the same shift. What is left is verified: every
key phrase has to stand there word by word, within ``slack`` words of its place.

The rare words are mandatory ones, so the lookup loses no file that would pass verification.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, columns_of, stage

#: The phrases that name a licence, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices and texts in use, key phrases in square brackets.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", """[Permission is hereby granted, free of charge, to any person obtaining a copy] of
        this software and associated documentation files (the "Software"), to deal in the Software
        [without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense], and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and [this permission notice shall be included in all copies] or
        substantial portions of the Software."""),
    ("apache", """[Licensed under the Apache License, Version 2.0]"""),
    ("apache", """Licensed under the [Apache License, Version 2.0] (the "License"); [you may not
        use this file except in compliance with the License]. You may obtain a copy of the License
        at"""),
    ("gpl", """This program is free software: [you can redistribute it and/or modify it under the
        terms of the GNU General Public License] as published by the [Free Software Foundation]"""),
    ("gpl", """[licensed under the GNU General Public License]"""),
    ("lgpl", """you can redistribute it and/or modify it [under the terms of the GNU Lesser General
        Public License] as published by the [Free Software Foundation]"""),
    ("lgpl", """[licensed under the GNU Lesser General Public License]"""),
    ("agpl", """you can redistribute it and/or modify it [under the terms of the GNU Affero General
        Public License] as published by the [Free Software Foundation]"""),
    ("agpl", """[licensed under the GNU Affero General Public License]"""),
    ("bsd", """[Redistribution and use in source and binary forms, with or without modification,
        are permitted] provided that the following conditions are met: [Redistributions of source
        code must retain the above copyright notice], this list of conditions and the following
        disclaimer. [Redistributions in binary form must reproduce the above copyright notice], this
        list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution."""),
    ("isc", """[Permission to use, copy, modify, and/or distribute this software for any purpose
        with or without fee is hereby granted], provided that the above copyright notice and [this
        permission notice appear in all copies]."""),
    ("mpl", """[This Source Code Form is subject to the terms of the Mozilla Public License], v.
        2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"""),
    ("mpl", """[licensed under the Mozilla Public License]"""),
    ("zlib", """[This software is provided 'as-is', without any express or implied warranty]. In no
        event will the authors be held liable for any damages arising from the use of this software.
        [Permission is granted to anyone to use this software for any purpose], including commercial
        applications, and to alter it and redistribute it freely"""),
    ("boost", """[Distributed under the Boost Software License, Version 1.0]"""),
    ("unlicense", """[This is free and unencumbered software released into the public domain].
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"""),
    ("cc0", """To the extent possible under law, [waived all copyright and related or neighboring
        rights to] this work"""),
    ("cc-by", """[licensed under a Creative Commons Attribution 4.0 International License]"""),
    ("cc-by", """[Licensed under CC BY 4.0]"""),
    ("cc-by-sa", """[licensed under a Creative Commons Attribution ShareAlike 4.0 International
        License]"""),
    ("cc-by-sa", """[Licensed under CC BY-SA 4.0]"""),
    ("cc-by-nc", """[licensed under a Creative Commons Attribution NonCommercial 4.0 International
        License]"""),
    ("cc-by-nc", """[Licensed under CC BY-NC 4.0]"""),
)

# Bytes of UTF-8: ASCII letters and digits, and all of any other sign.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def _words(raw: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a lower-cased text in order, in lists of about a megabyte."""
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + step)
        end = gap.start() if gap else len(raw)
        yield _WORD.findall(raw, at, end)
        at = end


def words(text: str) -> list[str]:
    return [w.decode() for some in _words(text.encode().lower()) for w in some]


class Template:
    """A template's words as numbers, and the place and words of each key phrase."""

    def __init__(self, label: str, text: str, number: Mapping[str, int]):
        self.label, self.words, self.phrases = label, [], []
        for part in re.split(r"(\[[^]]*\])", text):
            found = [number[w] for w in words(part)]
            if part[:1] == "[" and found:
                self.phrases.append((len(self.words), found))
            self.words += found
        if not self.phrases:
            raise ValueError(f"a template of {label} has no key phrase")


class Index:
    """Postings of every template's rarest mandatory words."""

    def __init__(self, templates: Sequence[tuple[str, str]], idf: Mapping[str, float], rare: int,
                 slack: int):
        self.slack, number = slack, vocabulary(templates)
        self.rank = {number[w]: i for i, w in enumerate(
            sorted(number, key=lambda w: (-idf.get(w, math.inf), w)))}
        self.templates = [Template(label, text, number) for label, text in templates]
        self.keys = [sorted({w for _, phrase in t.phrases for w in phrase},
                            key=self.rank.get)[:rare] for t in self.templates]
        #: word -> (template, place in it), of rare mandatory words only
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for n, t in enumerate(self.templates):
            for at, phrase in t.phrases:
                for i, w in enumerate(phrase, at):
                    if w in self.keys[n]:
                        self.postings[w].append((n, i))

    def candidates(self, places: Mapping[int, list[int]]) -> dict[int, list[int]]:
        """Template -> shifts at which its rarest word stands and all its other rare words do,
        too, about there. ``places``: the file's places of every licence word, ascending."""
        shifts: dict[tuple[int, int], set[int]] = defaultdict(set)
        full = {n for n, keys in enumerate(self.keys) if all(w in places for w in keys)}
        for w in sorted(places.keys() & self.postings.keys(), key=self.rank.get):
            for n, at in self.postings[w]:
                if n in full:
                    shifts[n, w].update(x - at for x in places[w])
        out = {}
        for n in full:
            first, *others = self.keys[n]
            rest = [sorted(shifts[n, w]) for w in others]
            kept = [s for s in sorted(shifts[n, first]) if all(
                bisect_left(r, s - 2 * self.slack) < bisect_right(r, s + 2 * self.slack)
                for r in rest)]
            if kept:
                out[n] = kept
        return out

    def verify(self, n: int, shifts: list[int], word_at: Mapping[int, int]) -> float:
        """The largest share of template ``n``'s words that stand in place where all its key
        phrases do; 0 if they nowhere do."""
        t, best = self.templates[n], 0.0

        def stands(phrase, x):
            return all(word_at.get(x + i) == w for i, w in enumerate(phrase))

        (first_at, first), *others = t.phrases
        tried = sorted({s + i for s in shifts for i in range(-self.slack, self.slack + 1)})
        for s in tried:
            if not stands(first, first_at + s):
                continue
            starts = [(0, s)]
            for at, phrase in others:
                near = next((s + i for i in sorted(range(-self.slack, self.slack + 1), key=abs)
                             if stands(phrase, at + s + i)), None)
                if near is None:
                    break
                starts.append((at, near))
            else:
                ends = [at for at, _ in starts[1:]] + [len(t.words)]
                there = sum(word_at.get(i + shift) == t.words[i]
                            for (at, shift), end in zip(starts, ends) for i in range(at, end))
                best = max(best, there / len(t.words))
        return best

    def scan(self, ids: Sequence[int], at: Sequence[int]) -> dict[str, float]:
        """Label -> best share, from the numbers and places of a file's licence words."""
        places: dict[int, list[int]] = defaultdict(list)
        for w, x in zip(ids, at):
            places[w].append(x)
        found: dict[str, float] = {}
        word_at = None
        for n, shifts in self.candidates(places).items():
            word_at = word_at or dict(zip(at, ids))
            share = self.verify(n, shifts, word_at)
            if share:
                label = self.templates[n].label
                found[label] = max(share, found.get(label, 0.0))
        return found


def vocabulary(templates: Sequence[tuple[str, str]]) -> dict[str, int]:
    """All licence words, those of the naming phrases included, in alphabetical order."""
    texts = [*(text for _, text in templates), *PHRASES]
    return {w: i for i, w in enumerate(sorted({w for text in texts for w in words(text)}))}


def _named(ids: Sequence[int], at: Sequence[int], phrases: Sequence[tuple[list[int], str]]
           ) -> list[tuple[int, str]]:
    """(start, label) of every place where a naming phrase stands."""
    out = []
    for i in range(len(ids)):
        for phrase, label in phrases:
            n = len(phrase)
            if ids[i] == phrase[0] and list(ids[i:i + n]) == phrase and at[i + n - 1] == at[i] + n - 1:
                out.append((at[i], label))
    return out


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, rare: int = 3,
         slack: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    ``n_base`` counts the places of naming phrases, from ``first_word`` to ``last_word`` (null if
    there is none); ``base_labels`` are their labels, ``labels`` also those of verified templates.
    ``score`` is the largest share of a template's words that stand in their places; a naming
    phrase is a template of its own, so it gives 1. Null and empty texts have no words, no labels
    and score 0. Repeated rows count and come back as often as they are there; null ids stay
    null; other columns are not read. Without rows there is no result.
    """
    templates = list(templates)
    number = vocabulary(templates)

    def places(batch):
        known = {w.encode(): i for w, i in number.items()}
        out: dict[str, list] = {"doc_id": batch["doc_id"], "n_words": [], "ids": [], "at": []}
        for text in batch["text"]:
            n, ids, at = 0, [], []
            for some in _words((text or "").encode().lower()):
                here = [i for i, w in enumerate(some) if w in known]
                at += [n + i for i in here]
                ids += [known[some[i]] for i in here]
                n += len(some)
            out["n_words"].append(n)
            out["ids"].append(ids)
            out["at"].append(at)
        return out

    read = stage(arrow_map(columns_of(docs, doc_id=id_col, text=text_col), places,
                           "doc_id long, n_words long, ids array<short>, at array<int>"),
                 "licence-words")
    # one row per licence word: their number is that of the templates' words
    seen = read.select(F.explode(F.array_distinct("ids")).alias("id")).groupBy("id").count()
    files, word = read.count(), {i: w for w, i in number.items()}
    idf = {word[r["id"]]: math.log((1 + files) / (1 + r["count"])) for r in seen.collect()}
    index = Index(templates, idf, rare, slack)
    naming = [([number[w] for w in words(p)], label) for p, label in PHRASES.items()]

    def labelled(batch):
        out = {"doc_id": batch["doc_id"], "n_words": batch["n_words"],
               **{c: [] for c in ("n_base", "first_word", "last_word", "base_labels", "labels",
                                  "score")}}
        for ids, at in zip(batch["ids"], batch["at"]):
            named = _named(ids, at, naming)
            found = index.scan(ids, at)
            base = {label for _, label in named}
            out["n_base"].append(len(named))
            out["first_word"].append(min((x for x, _ in named), default=None))
            out["last_word"].append(max((x for x, _ in named), default=None))
            out["base_labels"].append(",".join(sorted(base)))
            out["labels"].append(",".join(sorted(base | found.keys())))
            out["score"].append(1.0 if named else max(found.values(), default=0.0))
        return out

    return arrow_map(read, labelled, "doc_id long, n_words long, n_base long, first_word long, "
                                     "last_word long, base_labels string, labels string, "
                                     "score double")
