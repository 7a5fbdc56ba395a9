"""License scans (operator 1): matching statistics against a generalised
suffix automaton of licence templates, chained into covered template spans.

The automaton holds every word run of every template.  A text is streamed
through it word by word; at each word the state gives the longest run of words
ending there that occurs in some template (the matching statistics).  A run
that cannot be extended and is long enough becomes a match; matches of one
template that follow each other in the text and in the template are chained,
and the template words they cover give the template's score.  Short
phrases are found in the same stream: a phrase ends at a word if its own state
is the current state, or one of its suffix ancestors, and the matched length
reaches it.

Defined results: a null or empty text has no words, no labels and score 0;
rows are judged one by one (repeated rows, null ids and empty tables need no
special case); the whole text is streamed, with memory for its own words only.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varzea.llm.common import fresh, text_bytes

#: Words of a lower-cased UTF-8 text: ASCII letters and digits, all non-ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall

# Phrases whose every place counts, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Characteristic passages of common licences, and their labels.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
               "in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version"),
    ("lgpl", "GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

#: Shortest run of words that counts as a match of a template.
MIN_RUN = 4
#: Text words that may be missing or foreign between two chained matches.
MAX_GAP = 8
#: Share of a template's words that its chain must cover for its label.
MIN_COVER = 0.6


def words_of(text: bytes) -> list[bytes]:
    return WORD(text.lower())  # bytes.lower() changes A-Z only


class Automaton:
    """Generalised suffix automaton over word sequences."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            state = 0
            for place, word in enumerate(sequence):
                state = self._extend(state, word)
                self.ends[state].add((number, place + 1))
        # a state's strings also end wherever those of its suffix children end
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]

    def _new(self, length: int, nxt: dict[bytes, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        q = self.next[last].get(word)
        if q is not None:  # already in the automaton: from another sequence
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def step(self, state: int, matched: int, word: bytes) -> tuple[int, int]:
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        nxt = self.next[state].get(word)
        return (0, 0) if nxt is None else (nxt, matched + 1)


class Scanner:
    def __init__(self, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None):
        phrases = PHRASES if phrases is None else phrases
        templates = TEMPLATES if templates is None else templates
        self.phrase_words = [words_of(p.encode()) for p in phrases]
        self.phrase_label = list(phrases.values())
        self.template_words = [words_of(t.encode()) for _, t in templates]
        self.template_label = [label for label, _ in templates]
        self.sam = Automaton(self.phrase_words + self.template_words)
        self.known = set(self.sam.next[0])
        # phrases that may end in each state: on the state's suffix path
        own: dict[int, list[int]] = defaultdict(list)
        for k, words in enumerate(self.phrase_words):
            state = 0
            for w in words:
                state = self.sam.next[state][w]
            own[state].append(k)
        self.phrases_at: dict[int, list[tuple[int, int]]] = {}
        for s in range(1, len(self.sam.length)):
            found, t = [], s
            while t > 0:
                found += [(k, len(self.phrase_words[k])) for k in own.get(t, ())]
                t = self.sam.link[t]
            if found:
                self.phrases_at[s] = found

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """(start, phrase) of every phrase place, and the maximal runs (start, length, state) of MIN_RUN words or more."""
        places, runs = [], []
        step, phrases_at = self.sam.step, self.phrases_at
        state = matched = 0
        at = -1
        for i in [i for i, w in enumerate(words) if w in self.known]:
            if i != at + 1 and matched:  # foreign words lie between
                if matched >= MIN_RUN:
                    runs.append((at + 1 - matched, matched, state))
                state = matched = 0
            new, longer = step(state, matched, words[i])
            if matched >= MIN_RUN and longer <= matched:
                runs.append((i - matched, matched, state))
            state, matched, at = new, longer, i
            for k, n in phrases_at.get(state, ()):
                if n <= matched:
                    places.append((i + 1 - n, k))
        if matched >= MIN_RUN:
            runs.append((at + 1 - matched, matched, state))
        return places, runs

    def chain(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Per template its chains that lie in no better one: (template, first word, end word, template words covered)."""
        by_template: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        base = len(self.phrase_words)
        for start, length, state in runs:
            for number, end in self.sam.ends[state]:
                if number >= base:
                    by_template[number - base].append((start, end - length, length))
        out = []
        for t, found in by_template.items():
            chains = []
            open_chains: list[tuple[int, int, int, int]] = []  # text start, text end, template end, covered
            for start, place, length in sorted(found):
                chain = (start, start + length, place + length, length)
                open_chains = [c for c in open_chains if start <= c[1] + MAX_GAP]
                for c in open_chains:
                    if c[2] <= place + length and c[0] < start:
                        fresh_words = length - max(0, c[2] - place, c[1] - start)
                        if fresh_words > 0 and c[3] + fresh_words > chain[3]:
                            chain = (c[0], start + length, place + length, c[3] + fresh_words)
                open_chains.append(chain)
                chains.append(chain)
            firsts: list[int] = []  # of the chains taken, those that lie in no other: both ascend
            ends: list[int] = []
            for first, end, _, covered in sorted(chains, key=lambda c: -c[3]):
                k = bisect_right(firsts, first)
                if k and ends[k - 1] >= end:
                    continue
                out.append((t, first, end, covered))
                k = bisect_left(firsts, first)
                firsts[k:], ends[k:] = [first, *firsts[bisect_right(ends, end):]], [end, *ends[bisect_right(ends, end):]]
        return sorted(out)

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        places, runs = self.stream(words)
        spans = self.chain(runs)
        base = {self.phrase_label[k] for _, k in places}
        labels, score = set(base), 1.0 if base else 0.0
        for t, _, _, covered in spans:
            share = covered / len(self.template_words[t])
            score = max(score, min(1.0, share))
            if share >= MIN_COVER:
                labels.add(self.template_label[t])
        starts = [s for s, _ in places]
        return {"n_words": len(words), "n_base": len(places),
                "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": score,
                "spans": [{"label": self.template_label[t], "template": t, "first": a, "end": b, "covered": c}
                          for t, a, b, c in spans]}


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("template", T.LongType()),
                     T.StructField("first", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("covered", T.LongType())])
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
                       T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
                       T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
                       T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(SPAN))])


@F.pandas_udf(RESULT)
def scan_column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Pandas UDF: UTF-8 bytes of a text -> its licence scan."""
    s = scanner()
    for texts in batches:
        got = pd.DataFrame([s.scan(t) for t in texts], columns=RESULT.names)
        for c in ("first_word", "last_word"):
            got[c] = got[c].astype("Int64")
        yield got


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the licence scan (with the covered template spans) of every row."""
    r = fresh(docs, "scan")
    return docs.withColumn(r, scan_column.asNondeterministic()(text_bytes(docs))).select("doc_id", f"{r}.*")
