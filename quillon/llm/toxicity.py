"""Toxicity: a learned lexicon, Levenshtein automata over its trie, and context windows.

Learning uses at most ``MOST_LABELLED`` labelled rows a class, those with the smallest hashes of the
identifier. Words and word beginnings of the toxic ones that are rare in the
clean ones form the lexicon: all that pass a test of evidence. The trie of ``TABLE_TERMS`` terms at a time is intersected with
Levenshtein automata of one edit (for whole words of ``FUZZY_LETTERS`` letters or
more; an edit is one letter, whatever its bytes) and made deterministic, so a batch of words runs through a
table, one for each such trie, and most words leave it after a few letters. Exact and misspelled finds of
a term are weighed apart, by what they say about the training rows.

A find counts less where its window of ``WINDOW`` words holds a quotation mark or a word of report,
and more where other finds or words of address stand in it. A logistic model of four sums
over a whole text gives the score; identifiers, languages, sources and labels do
not enter it.

Nulls and repeats: a null or empty text has no finds and gets the score of none; labels of a
repeated identifier count as toxic if any is, and its smallest text is learned from; null labels or identifiers are not learned from;
without labels the lexicon is empty and all scores are 0. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.kernels import alnum_words, lower_ascii, row_slices, text_buffer
from quillon.llm.shared import share

MOST_LABELLED = 8_000
TABLE_TERMS = 400
FUZZY_LETTERS = 5
WINDOW = 6
REJECT = 0.7
_PREFIXES = range(4, 9)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_QUOTED, _REPORTED, _ADDRESS = 0.4, 0.6, 1.2
#: The last byte of " ' “ „ « and the first of " ' ” » in UTF-8.
_OPENING, _CLOSING = (0x22, 0x27, 0x9C, 0x9E, 0xAB), (0x22, 0x27, 0xE2, 0xC2)

REPORT_WORDS = (
    "said says quote quoted quotes word words term terms called calls cited reported "
    "sagte wort zitat begriff dit mot citation terme dijo palabra cita"
).split()
ADDRESS_WORDS = "you your youre u ihr du dein vous toi ton usted tu eres".split()


def lowered(raw: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals in UTF-8 become small letters."""
    out = lower_ascii(raw)
    if len(out) > 1:
        capital = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def letters_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and for each byte (and the end) how many letters begin before it."""
    if not len(data) or data.max() < 0x80:
        return data.astype(np.int32), np.arange(len(data) + 1)
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    more = np.concatenate([data, np.zeros(3, dtype=np.uint8)]).astype(np.int32)
    b0, b1, b2, b3 = (more[at + k] for k in range(4))
    b1, b2, b3 = b1 & 0x3F, b2 & 0x3F, b3 & 0x3F
    two, three, four = (b0 & 0x1F) << 6 | b1, (b0 & 0x0F) << 12 | b1 << 6 | b2, (b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3
    points = np.select([b0 < 0x80, b0 < 0xE0, b0 < 0xF0], [b0, two, three], four)
    return points, np.concatenate([[0], np.cumsum(lead)])


@dataclass(frozen=True)
class Term:
    text: bytes
    whole: bool
    weight: float

    @property
    def letters(self) -> list[int]:
        return [ord(c) for c in self.text.decode("utf-8", "replace")]


class Automaton:
    """The trie of the terms, intersected with Levenshtein automata of one edit, as a table."""

    def __init__(self, terms: list[Term], fuzzy_letters: int = FUZZY_LETTERS) -> None:
        self.terms = terms
        children: list[dict[int, int]] = [{}]
        whole: list[int] = [-1]
        begins: list[int] = [-1]
        bendable = [False]

        def add(at: int, letters: list[int]) -> int:
            for c in letters:
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    whole.append(-1)
                    begins.append(-1)
                    bendable.append(bendable[at])
                at = children[at][c]
            return at

        children.append({})  # the second trie holds the terms that may be misspelled
        whole.append(-1)
        begins.append(-1)
        bendable.append(True)
        for k, term in enumerate(terms):
            letters = term.letters
            if term.whole and len(letters) >= fuzzy_letters:
                whole[add(1, letters)] = k
            elif term.whole:
                whole[add(0, letters)] = k
            else:
                begins[add(0, letters)] = k
        alphabet = sorted({c for x in children for c in x})
        # The last class stands for all letters beyond the alphabet's largest.
        self.classes = np.zeros(max(alphabet, default=0) + 2, dtype=np.int32)
        self.classes[alphabet] = np.arange(1, len(alphabet) + 1)

        def skip(items: set) -> frozenset:
            out = set(items)
            for node, edits in items:
                if node >= 0 and edits == 0 and bendable[node]:
                    out |= {(child, 1) for child in children[node].values()}
            return frozenset(out)

        def step(items: frozenset, c: int) -> frozenset:
            out = set()
            for node, edits in items:
                if node < 0:  # a term's beginning was read: the rest of the word is free
                    out.add((node, edits))
                    continue
                child = children[node].get(c)
                if child is not None:
                    out.add((child, edits))
                    if begins[child] >= 0:
                        out.add((-1 - begins[child], 0))
                if edits == 0 and bendable[node]:
                    out.add((node, 1))
                    out |= {(x, 1) for x in children[node].values()}
            return skip(out)

        def label(items: frozenset) -> int:
            found = [(terms[-1 - n].weight, -1 - n, 0) for n, _ in items if n < 0]
            exact = {whole[n] for n, e in items if n >= 0 and e == 0}
            found += [(terms[whole[n]].weight - 10.0 * e, whole[n], e) for n, e in items if n >= 0 and whole[n] >= 0 and not (e and whole[n] in exact)]
            if not found:
                return -1
            _, k, e = max(found)
            return 2 * k + e

        start = skip({(0, 0), (1, 0)})
        numbers, states, table = {frozenset(): 0, start: 1}, [frozenset(), start], []
        at = 0
        while at < len(states):
            row = []
            for c in [-1, *alphabet]:
                to = step(states[at], c)
                if to not in numbers:
                    numbers[to] = len(states)
                    states.append(to)
                row.append(numbers[to])
            table.append(row)
            at += 1
        self.table = np.array(table, dtype=np.int32)
        self.labels = np.array([label(s) for s in states], dtype=np.int32)

    def read(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each word, letters from a start to an end, 2 * term + (1 if misspelled), or -1."""
        out = np.full(len(starts), -1, dtype=np.int32)
        if not self.terms or not len(starts):
            return out
        codes = self.classes[np.minimum(letters, len(self.classes) - 1)]
        live, at, state = np.arange(len(starts)), starts.copy(), np.ones(len(starts), dtype=np.int32)
        while len(live):
            state = self.table[state, codes[at]]
            at = at + 1
            over = at == ends[live]
            out[live[over]] = self.labels[state[over]]
            go = ~over & (state != 0)
            live, at, state = live[go], at[go], state[go]
        return out


class Automata:
    """Automata of ``TABLE_TERMS`` terms each, read as if they were one."""

    def __init__(self, terms: list[Term]) -> None:
        self.terms = terms
        self.parts = [Automaton(terms[k : k + TABLE_TERMS]) for k in range(0, len(terms), TABLE_TERMS)]
        self.worth = np.array([t.weight - 10.0 * e for t in terms for e in (0, 1)])

    def read(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each word 2 * term + (1 if misspelled), or -1."""
        out, before = np.full(len(starts), -1, dtype=np.int32), 0
        for part in self.parts:
            label = part.read(letters, starts, ends)
            at = np.flatnonzero(label >= 0)
            label = label[at] + 2 * before
            better = (out[at] < 0) | (self.worth[label] >= self.worth[out[at]])
            out[at[better]] = label[better]
            before += len(part.terms)
        return out


class Scorer:
    """Lexicon, automaton, weights of finds and the logistic model."""

    def __init__(self, terms: list[Term]) -> None:
        self.automaton = Automata(terms)
        self.weights = np.array([w for t in terms for w in (t.weight, 0.7 * t.weight)])
        self.model = np.array([0.0, 0.0, 0.0, 0.0, 0.0])
        words = sorted({w.encode() for w in (*REPORT_WORDS, *ADDRESS_WORDS)})
        self.cues = Automaton([Term(w, True, 1.0) for w in words], fuzzy_letters=1 << 30)
        self.reports = np.array([w.decode() in REPORT_WORDS for w in words])

    def finds(self, raw: np.ndarray, own: np.ndarray):
        data = lowered(raw)
        starts, ends, first = alnum_words(data, own)
        letters, number = letters_of(data)
        label = self.automaton.read(letters, number[starts], number[ends])
        return data, letters, number, starts, ends, first, label

    def features(self, raw: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Four sums for each row: finds in context, the strongest, their share of the words, and different terms."""
        data, letters, number, starts, ends, first, label = self.finds(raw, own)
        out = np.zeros((len(own) - 1, 4))
        hit = np.flatnonzero(label >= 0)
        weight = self.weights[label[hit]] if len(hit) else np.zeros(0)
        hit, weight = hit[weight > 0], weight[weight > 0]
        if not len(hit):
            return out
        row = np.searchsorted(first, hit, side="right") - 1
        lo, hi = np.maximum(hit - WINDOW, first[row]), np.minimum(hit + WINDOW + 1, first[row + 1])
        rows = np.unique(row)
        around = np.concatenate([np.arange(first[r], first[r + 1]) for r in rows])
        cue = self.cues.read(letters, number[starts[around]], number[ends[around]]) // 2
        factor = np.ones(len(hit))
        for mask, times in ((self.reports, _REPORTED), (~self.reports, _ADDRESS)):
            at = around[(cue >= 0) & mask[cue]]
            factor[np.searchsorted(at, hi) > np.searchsorted(at, lo)] *= times
        before = np.where(starts[hit] > own[row], data[starts[hit] - 1], 0)
        after = np.where(ends[hit] < own[row + 1], data[np.minimum(ends[hit], len(data) - 1)], 0)
        factor[np.isin(before, _OPENING) & np.isin(after, _CLOSING)] *= _QUOTED
        near = np.searchsorted(hit, hi) - np.searchsorted(hit, lo) - 1
        value = weight * factor * (1 + 0.25 * np.minimum(near, 4))
        total = np.bincount(row, weights=value, minlength=len(out))
        out[:, 0] = np.log1p(total)
        np.maximum.at(out[:, 1], row, weight * factor)
        out[:, 2] = np.log1p(100 * total / np.maximum(np.diff(first), 20))
        kinds = np.unique(row.astype(np.int64) * (2 * len(self.automaton.terms)) + label[hit])
        out[:, 3] = np.log1p(np.bincount(kinds // (2 * len(self.automaton.terms)), minlength=len(out)))
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.automaton.terms:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(self.model[0] + features @ self.model[1:], -40, 40)))


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Newton's method with a ridge; the first coefficient is the constant."""
    x = np.hstack([np.ones((len(features), 1)), features])
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * features.shape[1]])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (labels - p) - penalty @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _terms_of(text: bytes) -> set[bytes]:
    """The words of a text, marked by a zero byte at their end, and their beginnings."""
    out = set()
    for w in set(_WORD.findall(text)):
        out.add(w + b"\x00")
        try:
            letters = w.decode()
        except UnicodeDecodeError:
            continue
        out.update(letters[:k].encode() for k in _PREFIXES if k < len(letters))
    return out


def _term_counts(rows: DataFrame) -> DataFrame:
    def count(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            counts: Counter = Counter()
            for a, b in row_slices(offsets):
                raw = lowered(data[offsets[a] : offsets[b]]).tobytes()
                for k in range(a, b):
                    counts.update(_terms_of(raw[offsets[k] - offsets[a] : offsets[k + 1] - offsets[a]]))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return rows.select("text").mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))


def telling(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int, tried: int) -> DataFrame:
    """(term, n, c): the terms that can pass ``choose_terms``, from the counts (term, n) of both classes."""
    expected = n_toxic / (n_toxic + n_clean)
    both = toxic.join(clean.select("term", F.col("n").alias("c")), "term", "left").select("term", "n", F.coalesce("c", F.lit(0)).alias("c"))
    n, c, rounding = F.col("n"), F.col("c"), 1e-9
    weight = F.log((n + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))
    evidence = n * F.log(n / ((n + c) * expected)) + F.when(c > 0, c * F.log(c / ((n + c) * (1 - expected)))).otherwise(0.0)
    return both.where((weight >= 1.5 - rounding) & (evidence > float(np.log(tried + 1)) + 1 - rounding))


def choose_terms(toxic: dict[bytes, int], clean: dict[bytes, int], n_toxic: int, n_clean: int, tried: int | None = None) -> list[Term]:
    """Terms that tell the classes apart, without those that a longer or shorter one already stands for.

    A word that may be misspelled stays beside its beginning, as edits are looked for in whole words alone.
    ``tried`` terms were looked at; those that fail may be left out of ``toxic``.
    """
    def weight(t: bytes) -> float:
        return float(np.log((toxic[t] + 0.5) / (n_toxic + 1)) - np.log((clean.get(t, 0) + 0.5) / (n_clean + 1)))

    expected, tries = n_toxic / (n_toxic + n_clean), np.log((len(toxic) if tried is None else tried) + 1) + 1

    def evidence(t: bytes) -> float:
        """Log-likelihood ratio of the term's split over the classes against that of all rows."""
        a, b = toxic[t], clean.get(t, 0)
        return a * np.log(a / ((a + b) * expected)) + (b * np.log(b / ((a + b) * (1 - expected))) if b else 0.0)

    good = {t: w for t in toxic if (w := weight(t)) >= 1.5 and evidence(t) > tries}
    covered: set[bytes] = set()
    for t in good:  # a beginning that stands nearly always in one longer term says no more than that
        stem = t.rstrip(b"\x00")
        for k in range(1, len(stem) + (t != stem)):
            if stem[:k] in good and toxic[t] >= 0.9 * toxic[stem[:k]]:
                covered.add(stem[:k])
    kept = {t: w for t, w in good.items() if t not in covered}
    out = []
    for t, w in kept.items():
        stem = t.rstrip(b"\x00")
        bends = t != stem and len(stem.decode("utf-8", "replace")) >= FUZZY_LETTERS
        if bends or not any(stem[:k] in kept and kept[stem[:k]] >= w - 0.5 for k in range(1, len(stem) + (t != stem))):
            out.append((w * np.log1p(toxic[t]), t, w))
    out.sort(key=lambda x: (-x[0], x[1]))
    return [Term(t.rstrip(b"\x00"), t.endswith(b"\x00"), w) for _, t, w in out]


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST_LABELLED) -> Scorer:
    """The scorer fitted on labelled rows whose crc32(identifier as text) mod 3 is not 1."""
    marks = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & (F.crc32(F.col("id").cast("string")) % 3 != 1))
        .groupBy("id").agg(F.max("y").alias("y"))
    )
    order = F.xxhash64("id")
    some = [marks.where(kind).orderBy(order, "id").limit(most) for kind in ("y = 1", "y = 0")]
    marked = some[0].unionByName(some[1])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # A bounded sample, one row an identifier.
    rows = share(texts.join(F.broadcast(marked), "id").groupBy("id", "y").agg(F.min("text").alias("text")).repartition(12, "id")).df
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Scorer([])
    support = max(3, n_toxic // 500)
    candidates = share(_term_counts(rows.where("y = 1")).where(F.col("n") >= support)).df
    tried = candidates.count()
    found = telling(candidates, _term_counts(rows.where("y = 0")), n_toxic, n_clean, tried).collect()
    toxic, clean = {bytes(r["term"]): r["n"] for r in found}, {bytes(r["term"]): r["c"] for r in found}
    scorer = Scorer(choose_terms(toxic, clean, n_toxic, n_clean, tried))
    n_labels = 2 * len(scorer.automaton.terms)
    if not n_labels:
        return scorer

    def finds(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            y = batch.column(1).to_numpy()
            counts = np.zeros((2, n_labels), dtype=np.int64)
            for a, b in row_slices(offsets):
                *_, first, label = scorer.finds(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                hit = np.flatnonzero(label >= 0)
                row = np.searchsorted(first, hit, side="right") - 1
                pairs = np.unique(row.astype(np.int64) * n_labels + label[hit])
                np.add.at(counts, (y[a + pairs // n_labels], pairs % n_labels), 1)
            flat = counts.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["k", "n"])

    counts = np.zeros(2 * n_labels)
    for r in rows.select("text", "y").mapInArrow(finds, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[r["k"]] = r["n"]
    clean_n, toxic_n = counts.reshape(2, n_labels)
    odds = np.log((toxic_n + 0.5) / (n_toxic + 1)) - np.log((clean_n + 0.5) / (n_clean + 1))
    exact = np.repeat(scorer.weights[0::2], 2)
    learned_weight = np.clip(np.where(np.arange(n_labels) % 2 == 1, np.minimum(odds, 0.9 * exact), odds), 0, None)
    scorer.weights = np.where(toxic_n + clean_n >= 3, learned_weight, scorer.weights)

    def measure(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            out = [scorer.features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in row_slices(offsets)]
            if out:
                x = np.concatenate(out)
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in x.T], batch.column(1)], names=["f0", "f1", "f2", "f3", "y"])

    data = rows.select("text", "y").mapInArrow(measure, "f0 double, f1 double, f2 double, f3 double, y int").toPandas().to_numpy()
    scorer.model = fit_logistic(data[:, :4], data[:, 4])
    return scorer


def with_scores(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``toxicity``, a score from 0 to 1."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField("toxicity", DoubleType())])
    at = docs.columns.index(text_col)

    def score(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(at))
            parts = [scorer.scores(scorer.features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in row_slices(offsets)]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "toxicity"])

    return docs.mapInArrow(score, schema)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, held_out, score, predicted."""
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = with_scores(read, learned(docs, labels, id_col, text_col))
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select(
        F.col("id").alias(id_col), held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= REJECT).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    return with_scores(docs, learned(docs, labels, id_col, text_col), text_col).where(F.col("toxicity") < REJECT).select(*docs.columns)
