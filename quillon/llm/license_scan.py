"""License scans with a positional rare-token index.

The index holds the words of each licence template with their positions. Words are
weighed by their inverse document frequency over all documents (one count for each
template word, so its size follows the templates, not the corpus). Postings are kept for a template's
rarest words that make up ``PROBED`` of its weight. A text's licence words of highest frequency weight, those with postings,
are looked up; each find proposes a place where the template would start, and postings are intersected by relative position: a
place whose finds, give or take ``SLACK`` words, weigh too little to reach ``LEAST`` of the template with all its other words is out, so
no place that reaches it is lost. Only the places left are verified: the share of the template's words that stand at their
position, give or take ``SLACK``, and, the largest share first, every mandatory phrase inside the matched
stretch; the first place with both is the match. Base phrases count wherever their words stand consecutively.

Nulls and repeats: a null text counts as empty and has no words and no labels; repeated rows get
equal results. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.kernels import alnum_words, lower_ascii, prefix_hash, row_slices, span_hash, text_buffer

#: phrase: label
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: label: (template, mandatory phrases)
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software",
        ("permission is hereby granted", "free of charge"),
    ),
    "apache": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("apache license", "in compliance with the license"),
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version",
        ("gnu general public license", "free software"),
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        ("source and binary forms", "with or without modification"),
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file "
        "you can obtain one at http mozilla org mpl 2 0",
        ("mozilla public license",),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
        "copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    "cc-by-nc": ("licensed under cc by nc 4 0", ("cc by nc",)),
    "cc-by-sa": ("licensed under cc by sa 4 0", ("cc by sa",)),
}
LEAST = 0.6
SLACK = 3
PROBED = 0.7


def _words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def _hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hash(prefix_hash(raw), np.array([0]), np.array([len(raw)]))[0])


class _Text:
    """The words of a slice of texts, by hash and position."""

    def __init__(self, raw: np.ndarray, own: np.ndarray, vocabulary: np.ndarray, spelled: list[bytes]) -> None:
        lowered = lower_ascii(raw)
        self.starts, self.ends, self.first = alnum_words(lowered, own)
        hashes = span_hash(prefix_hash(lowered), self.starts, self.ends)
        at = np.searchsorted(vocabulary, hashes)
        at[at == len(vocabulary)] = 0
        known = np.flatnonzero(vocabulary[at] == hashes)
        # The few words of the vocabulary are held against their spelling.
        same = np.array([lowered[self.starts[i] : self.ends[i]].tobytes() == spelled[at[i]] for i in known], dtype=bool)
        self.code = np.full(len(hashes) + 1, -1, dtype=np.int32)
        self.code[known[same]] = at[known[same]]
        self.known = known[same]

    def phrase(self, codes: list[int], lo: int, hi: int) -> np.ndarray:
        """Places in the words lo..hi where the coded phrase stands."""
        at = np.arange(lo, hi - len(codes) + 1)
        for k, code in enumerate(codes):
            at = at[self.code[at + k] == code]
        return at


def document_frequency(docs: DataFrame, text_col: str) -> tuple[int, dict[str, int]]:
    """Rows, and rows that hold each template word: one count a word, over all documents."""
    vocabulary = sorted({w for text, _ in TEMPLATES.values() for w in _words(text)} | {w for p in BASE for w in _words(p)})
    codes = {_hash(w): w for w in vocabulary}
    hashes = np.array(sorted(codes), dtype=np.uint64)
    spelled = [codes[int(h)].encode() for h in hashes]

    def count(batches):
        seen = np.zeros(len(hashes) + 1, dtype=np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            seen[-1] += batch.num_rows
            for a, b in row_slices(offsets):
                text = _Text(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hashes, spelled)
                rows = np.searchsorted(text.first, text.known, side="right")
                pairs = np.unique(rows.astype(np.int64) * len(hashes) + text.code[text.known])
                seen[:-1] += np.bincount(pairs % len(hashes), minlength=len(hashes))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(seen))), pa.array(seen)], names=["code", "n"])

    counts = docs.select(F.col(text_col).alias("t")).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    found = {r["code"]: r["n"] for r in counts}
    return found.get(len(hashes), 0), {w.decode(): found.get(i, 0) for i, w in enumerate(spelled)}


class _Index:
    """Templates as word codes with weights, and the postings of their rarest words: template, position and weight by code."""

    def __init__(self, rows: int, frequency: dict[str, int]) -> None:
        idf = {w: math.log((rows + 1) / (n + 1)) + 1 for w, n in frequency.items()}
        self.hashes = np.array(sorted(_hash(w) for w in frequency), dtype=np.uint64)
        by_hash = {_hash(w): w for w in frequency}
        self.spelled = [by_hash[int(h)].encode() for h in self.hashes]
        code = {w.decode(): i for i, w in enumerate(self.spelled)}
        self.base = [([code[w] for w in _words(p)], label) for p, label in BASE.items()]
        self.labels, self.mandatory, self.templates, self.weights, need = [], [], [], [], []
        places: list[list[tuple[int, int, float]]] = [[] for _ in self.spelled]
        for t, (label, (text, phrases)) in enumerate(TEMPLATES.items()):
            words = _words(text)
            self.labels.append(label)
            self.templates.append(np.array([code[w] for w in words], dtype=np.int32))
            self.weights.append(np.array([idf[w] for w in words]))
            self.mandatory.append([[code[w] for w in _words(p)] for p in phrases])
            total, probed, probes = self.weights[t].sum(), 0.0, set()
            for w in sorted(set(words), key=lambda w: (-idf[w], w)):
                if probed >= PROBED * total:
                    break
                probes.add(w)
                probed += idf[w] * words.count(w)
            need.append(probed - (1 - LEAST) * total)
            for at, w in enumerate(words):
                if w in probes:
                    places[code[w]].append((t, at, idf[w]))
        self.need = np.array(need) - 1e-9
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in places])])
        flat = [x for own in places for x in own]
        self.template, self.at = (np.array([x[k] for x in flat], dtype=np.int64) for k in (0, 1))
        self.weight = np.array([x[2] for x in flat])

    def places(self, text: _Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, template, place) of the places whose postings agree enough, for a slice of texts."""
        codes = text.code[text.known]
        n = self.first[codes + 1] - self.first[codes]
        word = np.repeat(text.known, n)
        entry = np.repeat(self.first[codes], n) + np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
        row = np.searchsorted(text.first, word, side="right") - 1
        template, place, weight = self.template[entry], word - self.at[entry], self.weight[entry]
        # Rows and templates stand apart on one line, wider than any slack and template.
        wide = int(max((len(x) for x in self.templates), default=0)) + 2 * SLACK + 2
        span = len(text.code) + 2 * wide
        line = (row * len(self.templates) + template) * span + place + wide
        order = np.argsort(line, kind="stable")
        line, weight = line[order], np.concatenate([[0.0], np.cumsum(weight[order])])
        agreed = weight[np.searchsorted(line, line + SLACK, side="right")] - weight[np.searchsorted(line, line - SLACK, side="left")]
        enough = agreed >= self.need[template[order]]
        _, first = np.unique(line[enough], return_index=True)
        some = order[enough][first]
        return row[some], template[some], place[some]

    def share(self, text: _Text, t: int, place: int, lo: int, hi: int) -> float:
        """Share of the template's weight whose words stand at their position from ``place``, give or take SLACK, in the words lo..hi."""
        codes = self.templates[t]
        hit = np.zeros(len(codes), dtype=bool)
        for d in range(-SLACK, SLACK + 1):
            a, b = max(0, lo - place - d), min(len(codes), hi - place - d)
            if a < b:
                hit[a:b] |= text.code[place + d + a : place + d + b] == codes[a:b]
        return round(float(self.weights[t][hit].sum() / self.weights[t].sum()), 9)


def _matches(text: _Text, index: _Index):
    """(row, template, share, first word) of the verified matches of a slice."""
    found: dict[tuple[int, int], list[tuple[float, int]]] = {}
    for row, t, place in zip(*(x.tolist() for x in index.places(text)), strict=True):
        share = index.share(text, t, place, int(text.first[row]), int(text.first[row + 1]))
        if share >= LEAST:
            found.setdefault((row, t), []).append((-share, place))
    for (row, t), places in sorted(found.items()):
        lo, hi = int(text.first[row]), int(text.first[row + 1])
        for minus, place in sorted(places):
            a, b = max(lo, place - SLACK), min(hi, place + len(index.templates[t]) + SLACK)
            if all(len(text.phrase(p, a, b)) for p in index.mandatory[t]):
                yield row, t, -minus, max(lo, place) - lo
                break


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: n_words, the base phrases' places, and ``matches`` (label, share, first_word) of the method."""
    rows, frequency = document_frequency(docs, text_col)
    index = _Index(rows, frequency)
    kind = docs.schema[id_col].dataType.simpleString()
    match = pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64()), ("first_word", pa.int64())]))

    def scan(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            n = batch.num_rows
            n_words, n_base = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            first, last = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
            labels, matches = [[] for _ in range(n)], [[] for _ in range(n)]
            for a, b in row_slices(offsets):
                text = _Text(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], index.hashes, index.spelled)
                n_words[a:b] = np.diff(text.first)
                for codes, label in index.base:
                    at = text.known[text.code[text.known] == codes[0]]
                    for k in range(1, len(codes)):
                        at = at[text.code[at + k] == codes[k]]
                    row = np.searchsorted(text.first, at, side="right") - 1
                    inside = at + len(codes) <= text.first[row + 1]
                    for i, r in zip(at[inside], row[inside], strict=True):
                        place = int(i - text.first[r])
                        n_base[a + r] += 1
                        first[a + r] = place if first[a + r] < 0 else min(first[a + r], place)
                        last[a + r] = max(last[a + r], place)
                        labels[a + r].append(label)
                for row, t, share, at in _matches(text, index):
                    matches[a + row].append({"label": index.labels[t], "share": share, "first_word": at})
            none = first < 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n_words), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                    pa.array([sorted(set(x)) for x in labels], pa.list_(pa.string())), pa.array(matches, match),
                ],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base", "matches"],
            )

    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(
            scan,
            f"id {kind}, n_words long, n_base long, first_word long, last_word long, base array<string>, "
            "matches array<struct<label: string, share: double, first_word: long>>",
        )
        .withColumnRenamed("id", id_col)
    )


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digest of ``scanned``: labels joined by commas, and a score (1 for a base phrase, else the best share)."""
    found = F.transform("matches", lambda m: m["label"])
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0))
    return scanned(docs, id_col, text_col).select(
        id_col, "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
