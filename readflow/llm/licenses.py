"""License scans: a generalised suffix automaton of licence texts, matching statistics, chained template spans."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

from readflow.llm.texts import words_of

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public licence texts and notices, by label.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "Released under the MIT License."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
     rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
     persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
     and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
     PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
     MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
     HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
     ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
     the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
     conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
     this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
     distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
     granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
     required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
     IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
     language governing permissions and limitations under the License."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
     Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
     later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
     the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
     more details. You should have received a copy of the GNU General Public License along with this program. If not, see
     https://www.gnu.org/licenses/."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
     not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

MIN_MATCH = 3  # words of a match that may be chained
MAX_GAP = 12  # words a chain may skip in the document
MIN_COVERAGE = 0.6  # covered share of a template that makes a span
MIN_WORDS = 20  # or so many covered words, for parts of long templates
SHORT_SPAN = 8  # a span of fewer covered words must hold the words that tell its label


class Span(NamedTuple):
    first: int  # word, from 0
    end: int  # exclusive
    label: str
    coverage: float


class Automaton:
    """Suffix automaton of several word sequences; each state knows one place per sequence where its words end."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        sequences = [(label, words_of(text)) for label, text in templates] + [(label, p.split()) for p, label in phrases.items()]
        self.words = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in sequences for w in ws))}
        self.labels = [label for label, _ in sequences]
        holders: dict[str, set[str]] = defaultdict(set)
        for label, ws in sequences[: len(templates)]:
            for w in ws:
                holders[w].add(label)
        #: Per template the words that no template of another label holds.
        self.telling = [{self.words[w] for w in ws if len(holders[w]) == 1} for _, ws in sequences[: len(templates)]]
        self.sizes = [len(ws) for _, ws in sequences]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[dict[int, int]] = [{}]
        codes = [[self.words[w] for w in ws] for _, ws in sequences]
        for code in codes:
            last = 0
            for c in code:
                last = self._extend(last, c)
        for t, code in enumerate(codes):  # every state on the way up holds the words that end here
            state = 0
            for end, c in enumerate(code, 1):
                state = up = self.next[state][c]
                while up > 0 and t not in self.places[up]:
                    self.places[up][t] = end
                    up = self.link[up]
        self.phrases: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)  # (sequence, words) a state's words may end with
        whole = {}
        for t in range(len(templates), len(sequences)):
            state = 0
            for c in codes[t]:
                state = self.next[state][c]
            whole.setdefault(state, []).append((t, self.sizes[t]))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.phrases[state] = (*whole.get(state, ()), *(self.phrases[self.link[state]] if self.link[state] > 0 else ()))

    def _new(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(dict(follow))
        self.link.append(link)
        self.length.append(length)
        self.places.append({})
        return len(self.next) - 1

    def _split(self, state: int, c: int) -> int:
        """The state of (``state``'s words + c) alone, cut off from longer ones if need be."""
        old = self.next[state][c]
        if self.length[old] == self.length[state] + 1:
            return old
        copy = self._new(self.length[state] + 1, self.link[old], self.next[old])
        self.link[old] = copy
        while state >= 0 and self.next[state].get(c) == old:
            self.next[state][c] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, c)
        return new

    def statistics(self, code: list[int]) -> Iterator[tuple[int, int]]:
        """Per word: the state and the length of the longest run ending there that some sequence holds."""
        state = held = 0
        nexts, links, lengths = self.next, self.link, self.length
        for c in code:
            while state and c not in nexts[state]:
                state = links[state]
                held = lengths[state]
            if c in nexts[state]:
                state = nexts[state][c]
                held += 1
            yield state, held


class Scan(NamedTuple):
    n_words: int
    places: list[tuple[int, str]]  # (first word, label) of the base phrases
    spans: list[Span]


def scan_words(automaton: Automaton, words: list[str], n_templates: int) -> Scan:
    """Base phrases and template spans of a text.

    Words that no template holds break every match, so only runs of known words are streamed through
    the automaton. A match that the next word does not prolong is kept with its place in each
    template; per template the matches are chained in order of both texts (``chain``). A span of fewer
    than ``SHORT_SPAN`` covered words also holds every word that only templates of its label hold
    (``mit``; ``cc`` and ``nc``): a few common words alone are no licence.
    """
    codes = np.fromiter((automaton.words.get(w, -1) for w in words), np.int32, len(words))
    known = np.flatnonzero(np.diff(np.concatenate(([0], (codes >= 0).view(np.int8), [0]))))
    places: list[tuple[int, str]] = []
    matches: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for first, end in zip(known[::2].tolist(), known[1::2].tolist()):
        if end - first < 2:
            continue
        before = (0, 0)
        at = first
        for state, held in (*automaton.statistics(codes[first:end].tolist()), (0, 0)):
            if before[1] >= MIN_MATCH and held <= before[1]:
                for t, place in automaton.places[before[0]].items():
                    if t < n_templates:
                        matches[t].append((at - before[1], place - before[1], before[1]))
            for t, size in automaton.phrases[state]:
                if held >= size:
                    places.append((at + 1 - size, automaton.labels[t]))
            before = (state, held)
            at += 1
    spans = []
    for t, own in matches.items():
        for s in chain(own, automaton.sizes[t], automaton.labels[t]):
            covered = s.coverage * automaton.sizes[t]
            if covered > SHORT_SPAN - 0.5 or automaton.telling[t] and automaton.telling[t] <= set(codes[s.first : s.end].tolist()):
                spans.append(s)
    return Scan(len(words), sorted(places), sorted(set(spans)))


def chain(matches: list[tuple[int, int, int]], size: int, label: str) -> list[Span]:
    """Spans of one template from (document word, template word, length) matches in document order.

    A match joins the running chain if it goes on in the template and skips at most ``MAX_GAP``
    words of the document; overlaps count once. Else the chain ends and a new one begins. A chain
    that covers ``MIN_COVERAGE`` of the template or ``MIN_WORDS`` of its words becomes a span.
    """
    spans, first, end, place, covered = [], 0, -1, 0, 0
    for d, t, n in [*matches, (1 << 60, 0, 0)]:
        overlap = max(0, end - d, place - t)
        if covered and d - end <= MAX_GAP and n > overlap and t + n > place:
            covered += n - overlap
            end, place = d + n, t + n
            continue
        if covered and (covered >= MIN_COVERAGE * size or covered >= MIN_WORDS):
            spans.append(Span(first, end, label, round(min(1.0, covered / size), 6)))
        first, end, place, covered = d, d + n, t + n, n
    return spans


SCAN_TYPE = ("struct<n_words:bigint,places:array<struct<first:int,label:string>>,"
             "spans:array<struct<first:int,end:int,label:string,coverage:double>>>")
_PLACE = pa.struct([("first", pa.int32()), ("label", pa.string())])
_SPAN = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("coverage", pa.float64())])


def license_scan(text: Column, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> Column:
    """Struct (n_words, places, spans) per text: base phrases, and covered spans of ``templates``.

    Null and empty texts have no words, places or spans. Overlapping spans of different templates
    are all kept. The automaton is built once per task, from the templates alone.
    """

    @F.arrow_udf(DataType.fromDDL(SCAN_TYPE))
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = Automaton(templates, phrases)
        for batch in batches:
            rows = [scan_words(automaton, words_of(t.as_py() or ""), len(templates)) for t in batch]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([r.n_words for r in rows], pa.int64()),
                    pa.array([[{"first": a, "label": b} for a, b in r.places] for r in rows], pa.list_(_PLACE)),
                    pa.array([[s._asdict() for s in r.spans] for r in rows], pa.list_(_SPAN)),
                ],
                ["n_words", "places", "spans"])

    return scanned(text)


def scan_score(scan: Column) -> Column:
    """0 to 1: the best coverage of a template, and at least one half where a base phrase stands."""
    best = F.coalesce(F.array_max(F.transform(scan["spans"], lambda s: s["coverage"])), F.lit(0.0))
    return F.greatest(best, F.when(F.size(scan["places"]) > 0, 0.5).otherwise(0.0))


def labels_of(*arrays: Column) -> Column:
    """The distinct labels of arrays of labelled structs, sorted and comma-joined."""
    names = F.concat(*[F.transform(a, lambda s: s["label"]) for a in arrays])
    return F.array_join(F.array_sort(F.array_distinct(names)), ",")
