"""Operators over documents against brute force, with awkward rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillon.llm import exact_dedup, kernels, license_scan, mixing, near_dedup, packing, suffix_dedup, toxicity


def sizes(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_kernel_words_do_not_cross_rows():
    import pyarrow as pa

    column = pa.array(["ab cd", None, "", "ef", " g\n", "é è"])
    assert kernels.count_words(column).tolist() == [2, 0, 0, 1, 1, 2]
    assert kernels.count_words(column[1:4]).tolist() == [0, 0, 1]


def test_kernel_hash_depends_on_bytes_alone():
    data = np.frombuffer(b"abcXabc", dtype=np.uint8)
    sums = kernels.prefix_hash(data)
    a, b, c = kernels.span_hash(sums, np.array([0, 4, 1]), np.array([3, 7, 4]))
    assert a == b != c


class TestExactDedup:
    def test_against_groups(self, docs, texts):
        got = exact_dedup.exact_dedup(docs).collect()
        assert len(got) == len(texts)
        groups = defaultdict(list)
        for i, t, _ in texts:
            groups[normal(t)].append(i)
        by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
        kept = Counter()
        for r in got:
            ids = by_sha[r.text_sha256]
            assert r.group_size == len(ids)
            assert r.keep_id == min((i for i in ids if i is not None), default=None)
            kept[r.text_sha256] += r.kept
        assert set(kept.values()) == {1}

    def test_keep_first_keeps_one_row_each(self, docs, texts):
        out = exact_dedup.keep_first(docs)
        assert out.columns == docs.columns
        assert sorted(normal(r.text) for r in out.collect()) == sorted({normal(t) for _, t, _ in texts})

    def test_empty(self, no_docs):
        assert exact_dedup.exact_dedup(no_docs).count() == 0
        assert exact_dedup.keep_first(no_docs).count() == 0


def components(texts, n, percent):
    sets = {}
    for k, (i, t, _) in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = frozenset(tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))) if w else frozenset()
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in sets:
        for y in range(x):
            if sets[x] and sets[y]:
                common = len(sets[x] & sets[y])
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common) and None not in (texts[x][0], texts[y][0]):
                    parent[find(x)] = find(y)
    least = defaultdict(list)
    for k, (i, _, _) in enumerate(texts):
        if i is not None:
            least[find(k)].append(i)
    return {k: (min(least[find(k)], default=None), len(sets[k])) for k in sets}


class TestNearDedup:
    @pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
    def test_against_all_pairs(self, docs, texts, n, percent):
        want = components(texts, n, percent)
        expected = sorted((i, want[k][1], want[k][0]) for k, (i, _, _) in enumerate(texts) if i is not None)
        got = near_dedup.near_dedup(docs, shingle=n, percent=percent).collect()
        assert len(got) == len(texts)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == expected
        assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)

    def test_families_of_near_copies_in_small_blocks(self, spark, monkeypatch):
        monkeypatch.setattr(near_dedup, "BLOCK", 20)
        rnd = random.Random(3)
        rows = []
        for _ in range(2):
            base = [str(rnd.randint(0, 2000)) for _ in range(120)]
            for _ in range(70):
                rate = rnd.choice([0, 0.01, 0.03, 0.05, 0.1])
                rows.append((len(rows), " ".join(str(rnd.randint(0, 2000)) if rnd.random() < rate else w for w in base), None))
        want = components(rows, 3, 85)
        df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
        got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(df, shingle=3, percent=85).collect()}
        assert got == {k: want[k][0] for k in want}

    def test_identifiers_are_integers(self, docs):
        with pytest.raises(TypeError):
            near_dedup.near_dedup(docs, id_col="id")

    def test_pigeonhole_covers_every_signature_pair_in_reach(self):
        distance = near_dedup.allowed_distance(85)
        chunks = near_dedup.chunks_for(distance)
        assert len(chunks) * (near_dedup.CHUNK_ERRORS + 1) > distance
        assert sorted(np.concatenate(chunks)) == list(range(near_dedup.SYMBOLS))

    def test_representatives(self, docs):
        out = near_dedup.keep_representatives(docs)
        assert out.columns == docs.columns
        assert {3, 4, 5}.issubset({r.doc_id for r in out.collect()})

    def test_empty(self, no_docs):
        assert near_dedup.near_dedup(no_docs).count() == 0


def mixed_model(rows, block):
    """(id, taken, first_slot, n_slots, [(pass, slot, text)]) of each row by one machine: lists, sorting and counting."""
    import hashlib
    import math

    sized = [(i, s, t or "", sizes(t)) for i, s, t in rows]
    names = sorted({s for _, s, _, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for _, x, _, n in sized if x == s) for s in names}
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}
    target, left, open_weight, level = {}, 1.5 * sum(total.values()), sum(weight.values()), None
    for s in sorted(names, key=lambda s: (2 * total[s] / weight[s], names.index(s))):
        if level is None and 2 * total[s] * open_weight > left * weight[s]:
            level = left / open_weight
        target[s] = float(2 * total[s]) if level is None else level * weight[s]
        left, open_weight = left - 2 * total[s], open_weight - weight[s]
    words = {s: math.floor(target[s]) for s in names}
    quota = {s: -(-words[s] // block) for s in names}
    slots, circle, mask = sum(quota.values()), 1 << 62, (1 << 64) - 1
    bounds, at = [], 0
    for s in names:
        begin, at = at, at + quota[s]
        bounds.append((s, math.floor(begin / slots * circle) if begin < slots else circle, circle if at == slots else math.floor(at / slots * circle)))
    got, places = Counter(), {}
    for i in range(slots):
        point = (i * 0x9E3779B97F4A7C15 & mask) >> 2
        s = next(s for s, lo, hi in bounds if lo <= point < hi)
        if got[s] < quota[s]:
            places[s, got[s]] = i
        got[s] += 1
    for k, s in enumerate(names):
        for rank in range(got[s], quota[s]):
            places[s, rank] = slots + rank * len(names) + k
    block_slot = {}
    for s in names:
        first = min(quota[s], total[s] // block)
        for n, base in ((first, 0), (quota[s] - first, first)):
            step = min(int(0.618 * n), 1 << 28) | 1
            while math.gcd(step, max(n, 1)) != 1:
                step += 2
            for x in range(n):
                block_slot[s, base + x * step % n] = places[s, base + x]
    out, at = [], Counter()
    for i, s, t, n in sorted(sized, key=lambda r: (hashlib.md5(b"" if r[0] is None else str(r[0]).encode()).digest(), r[3])):
        own, taken, seen = [], 0, []
        for p in range(2 if n else 0):
            a = at[s] + p * total[s]
            b = min(a + n, words[s])
            if a < b:
                used = [block_slot[s, k] for k in range(a // block, (b - 1) // block + 1)]
                ends = [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
                own.append((p, min(used), t if b - a == n else t[: ends[b - a - 1]]))
                taken, seen = taken + b - a, seen + used
        at[s] += n
        out.append((i, taken, min(seen, default=None), len(seen), own))
    return out


class TestMixing:
    def plan(self, spark, sizes, share, block=10):
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        return mixing.plan_sources(rows, share_of_all=share, block=block)

    def test_targets(self, spark):
        got = {r["name"]: r for r in self.plan(spark, {"a": 100, "b": 100, "c": 100}, 1.5).df.collect()}
        assert [got[x].target for x in "abc"] == [200, pytest.approx(500 / 3), pytest.approx(250 / 3)]
        sizes = {None: 40, "b": 20, "c": 30, "a": 10, "é": 0}
        got = sorted(self.plan(spark, sizes, 1.5).df.collect(), key=lambda r: r.s)
        assert [r["name"] for r in got] == ["a", "b", "c", "é", None]
        assert sum(r.target for r in got) == pytest.approx(150) and all(r.target <= 2 * r.source_size for r in got)
        assert got[0].lo == 0 and got[-1].hi == mixing._CIRCLE and all(x.hi == y.lo for x, y in zip(got, got[1:], strict=False))

    def test_words_meet_the_targets(self, docs, texts):
        got = mixing.mixed_documents(docs, block=50).collect()
        assert len(got) == len(texts)
        taken, target = Counter(), {}
        total = Counter()
        source = {}
        for i, t, s in texts:
            total[s] += sizes(t)
            source.setdefault((i, sizes(t)), []).append(s)
        for r in got:
            assert r.taken <= 2 * r.size
            taken[r.target] += r.taken
            target[r.target] = r.source_size
        assert all(abs(n - t) <= 1 for t, n in taken.items())
        assert sorted(set(target.values())) == sorted(set(total.values()))
        again = mixing.mixed_documents(docs.repartition(2), block=50).collect()
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken, r.first_slot or 0)
        assert sorted(got, key=key) == sorted(again, key=key)

    def test_schedule_is_whole_and_even(self, spark):
        plan = self.plan(spark, {"a": 5000, "b": 900, "c": 10, "d": 3}, 1.5)
        quotas = {r.s: r.quota for r in plan.df.collect()}
        rows = mixing.schedule(plan).collect()
        assert len({r.slot for r in rows}) == len(rows)
        for s, quota in quotas.items():
            assert sorted(r.block for r in rows if r.s == s) == list(range(quota))
        half = sorted(rows, key=lambda r: r.slot)[: len(rows) // 2]
        assert abs(sum(r.s == 0 for r in half) - quotas[0] / 2) <= 4
        first = [r.block for r in sorted(rows, key=lambda r: r.slot) if r.s == 0]
        assert first != sorted(first)  # blocks are shuffled

    def test_against_a_model(self, spark, docs):
        rows = docs.collect()
        want = mixed_model([(r.doc_id, r.source, r.text) for r in rows], 50)
        got = Counter((r.doc_id, r.taken, r.first_slot, r.n_slots) for r in mixing.mixed_documents(docs, block=50).collect())
        assert got == Counter((i, n, slot, k) for i, n, slot, k, _ in want)
        out = mixing.mixed_corpus(docs, block=50)
        assert out.columns == [*docs.columns, "mix_pass", "mix_slot"]
        got = out.collect()
        assert Counter((r.doc_id, r.mix_pass, r.mix_slot, r.text, r.n_chars) for r in got) == Counter((i, p, slot, t, len(t)) for i, _, _, _, own in want for p, slot, t in own)
        assert [r.mix_slot for r in got] == sorted(r.mix_slot for r in got)

    def test_sources_of_another_type(self, spark):
        rows = [(k, k % 3, "a b c d e f") for k in range(20)] + [(3, 0, "a b c d e f")] * 2
        df = spark.createDataFrame(rows, "doc_id long, source int, text string")
        taken = sum(r.taken for r in mixing.mixed_documents(df, block=7).collect())
        assert taken == pytest.approx(1.5 * 22 * 6, abs=3)
        assert sum(sizes(r.text) for r in mixing.mixed_corpus(df, block=7).collect()) == taken

    def test_empty(self, no_docs):
        assert mixing.mixed_documents(no_docs).count() == 0
        assert mixing.mixed_corpus(no_docs).count() == 0


class TestPacking:
    def test_bounds_are_optimal(self):
        rnd = random.Random(1)
        for _ in range(60):
            lengths = np.array(sorted(rnd.sample(range(1, 40), rnd.randint(1, 8))))
            counts = np.array([rnd.randint(1, 9) for _ in lengths])
            k = rnd.randint(1, 4)
            bounds = packing.best_bounds(lengths, counts, k)
            cost = lambda bs: sum(c * (min(b for b in bs if b >= n) - n) for n, c in zip(lengths, counts, strict=True))
            from itertools import combinations

            options = [c for r in range(1, k + 1) for c in combinations(lengths.tolist(), r) if c[-1] == lengths[-1]]
            assert len(bounds) <= k
            assert cost(bounds) == min(cost(o) for o in options)

    def test_pieces_and_batches(self, docs, texts):
        rows = packing.packed(docs, most=64, buckets=3, batch_tokens=256, with_text=True).collect()
        pieces = defaultdict(list)
        for r in sorted(rows, key=lambda r: r.piece):
            assert sizes(r.text) == r.n_tokens and r.first_token == (64 * r.piece if r.n_tokens else 0)
            pieces[r.doc_id, r.row] += re.findall(r"[^\x20\x09-\x0D]+", r.text)
        assert Counter((i, *w) for (i, _), w in pieces.items()) == Counter((i, *re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in texts)
        total = Counter()
        for r in rows:
            total[r.doc_id] += r.n_tokens
            assert (r.bucket is None) == (r.n_tokens == 0)
        want = Counter()
        for i, t, _ in texts:
            want[i] += sizes(t)
        assert total == want
        batches = defaultdict(list)
        for r in rows:
            if r.bucket is not None:
                assert r.n_tokens <= r.bucket_len
                batches[r.bucket, r.batch].append(r)
        for (bucket, batch), own in batches.items():
            room = max(1, 256 // own[0].bucket_len)
            assert sorted(r.slot for r in own) == list(range(len(own)))
            assert len(own) == room or batch == max(b for k, b in batches if k == bucket)

    def test_empty(self, no_docs):
        assert packing.packed(no_docs).count() == 0


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()).hexdigest()))
    return out


class TestSuffixDedup:
    def rows(self, rnd):
        letter = lambda n: "".join(rnd.choice("ab ") for _ in range(n))
        shared = [letter(k) for k in (30, 45, 60)]
        texts = [None, "", "a" * 200, "ab" * 70, letter(39), shared[1], shared[1]]
        for _ in range(40):
            texts.append("".join(rnd.choice([letter(rnd.randint(0, 50)), rnd.choice(shared), "é" * rnd.randint(0, 3)]) for _ in range(rnd.randint(1, 6))))
        return texts

    @pytest.mark.parametrize("most", [4096, 2])
    def test_against_brute_force(self, spark, monkeypatch, most):
        monkeypatch.setattr(suffix_dedup, "MOST_IN_TASK", most)
        texts = self.rows(random.Random(11))
        df = spark.createDataFrame([(i if i != 8 else None, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, runs string").repartition(4)
        out = suffix_dedup.without_repeats(df, length=40, anchor=12).collect()
        got = sorted((r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256) for r in out)
        assert got == sorted(brute_repeats(texts, 40))

    def test_rows_that_share_an_identifier(self, spark):
        texts = self.rows(random.Random(12))
        df = spark.createDataFrame([(7 if i % 2 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
        out = suffix_dedup.without_repeats(df, length=40, anchor=12).collect()
        assert sorted((r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256) for r in out) == sorted(brute_repeats(texts, 40))

    def test_long_texts_come_in_chunks(self, spark, monkeypatch):
        monkeypatch.setattr(suffix_dedup, "_CHUNK", 300)
        rnd = random.Random(2)
        part = "".join(rnd.choice("abcd") for _ in range(500))
        texts = ["".join(rnd.choice("abcd") for _ in range(900)) + part + "x" * 700, "y" + part + "z", "q" * 30]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        out = suffix_dedup.without_repeats(df, length=40, anchor=12).collect()
        assert sorted((r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256) for r in out) == sorted(brute_repeats(texts, 40))

    def test_empty(self, no_docs):
        assert suffix_dedup.digest(no_docs).count() == 0


class TestLicenseScan:
    def test_base_places_and_awkward_rows(self, docs, texts, spark):
        got = license_scan.licenses(docs)
        assert got.count() == len(texts)
        lines = ["Released under the MIT License. The mit-license!", "mit", "license mit", "GNU General  Public\nLicense, Apache License", None, ""]
        rows = {r.doc_id: r for r in license_scan.licenses(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()}
        assert (rows[0].n_base, rows[0].first_word, rows[0].last_word, rows[0].base_labels, rows[0].score) == (2, 3, 6, "mit", 1.0)
        assert rows[1].n_base == rows[2].n_base == 0
        assert rows[3].base_labels == "apache,gpl"
        assert (rows[4].n_words, rows[4].first_word, rows[4].labels, rows[4].score) == (0, None, "", 0.0)

    def test_a_phrase_does_not_cross_rows(self, spark):
        df = spark.createDataFrame([(0, "the mit"), (1, "license here")], "doc_id long, text string").coalesce(1)
        assert license_scan.licenses(df).agg({"n_base": "sum"}).first()[0] == 0

    def test_templates_are_found_where_they_stand(self, spark):
        filler = "lorem ipsum dolor sit amet " * 20
        rows = [(k, filler + text + " " + filler) for k, (text, _) in enumerate(license_scan.TEMPLATES.values())]
        damaged = license_scan.TEMPLATES["bsd"][0].split()
        del damaged[1], damaged[24]  # outside the mandatory phrases
        rows.append((100, " ".join(damaged)))
        rows.append((101, " ".join(reversed(license_scan.TEMPLATES["bsd"][0].split()))))
        out = {r.doc_id: {m.label: m for m in r.matches} for r in license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        for k, label in enumerate(license_scan.TEMPLATES):
            assert label in out[k]
            assert abs(out[k][label].first_word - 100) <= license_scan.SLACK
        assert "bsd" in out[100]
        assert "bsd" not in out[101]

    def test_labels_against_every_place(self, spark):
        import math

        rnd = random.Random(6)
        words = [w for text, _ in license_scan.TEMPLATES.values() for w in text.split()] + ["lorem", "ipsum"]
        rows = []
        for k in range(60):
            text: list[str] = []
            for _ in range(rnd.randint(0, 3)):
                own = rnd.choice(list(license_scan.TEMPLATES.values()))[0].split()
                text += [rnd.choice(words) if rnd.random() < 0.3 * (k % 4) / 3 else w for w in own if rnd.random() > 0.05 * (k % 3)]
                text += rnd.choices(words, k=rnd.randint(0, 30))
            rows.append((k, " ".join(text)))
        vocabulary = {w for text, _ in license_scan.TEMPLATES.values() for w in text.split()}
        idf = {w: math.log((len(rows) + 1) / (sum(w in t.split() for _, t in rows) + 1)) + 1 for w in vocabulary}
        slack = license_scan.SLACK
        want = {}
        for k, t in rows:
            own, labels = t.split(), set()
            for label, (template, phrases) in license_scan.TEMPLATES.items():
                parts = template.split()
                for place in range(-len(parts), len(own)):
                    near = [own[max(0, place + j - slack) : max(0, place + j + slack + 1)] for j in range(len(parts))]
                    share = sum(idf[w] for w, n in zip(parts, near, strict=True) if w in n) / sum(idf[w] for w in parts)
                    stretch = " ".join(["", *own[max(0, place - slack) : max(0, place + len(parts) + slack)], ""])
                    # A place counts if a word of the template stands exactly where it says.
                    exact = any(0 <= place + j < len(own) and own[place + j] == w for j, w in enumerate(parts))
                    if exact and share >= license_scan.LEAST and all(f" {p} " in stretch for p in phrases):
                        labels.add(label)
            want[k] = labels
        out = license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        got = {r.doc_id: {m.label for m in r.matches} for r in out}
        assert sum(map(len, want.values())) >= 30
        assert got == want

    def test_a_broken_better_place_does_not_hide_a_whole_one(self, spark):
        filler = " lorem ipsum dolor sit amet" * 30
        rows, texts = [], license_scan.TEMPLATES
        broken = texts["mit"][0].replace("free of charge", "free of cost")
        words = texts["mit"][0].split()
        whole = " ".join(words[:-6])  # a smaller share, with its phrases
        rows = [(0, broken + filler), (1, whole + filler), (2, broken + filler + " " + whole), (3, whole + filler + " " + broken)]
        out = {r.doc_id: {m.label: m for m in r.matches} for r in license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert "mit" not in out[0] and "mit" in out[1] and "mit" in out[2] and "mit" in out[3]
        assert abs(out[2]["mit"].first_word - len((broken + filler).split())) <= license_scan.SLACK
        assert out[3]["mit"].first_word <= license_scan.SLACK

    def test_empty(self, no_docs):
        assert license_scan.licenses(no_docs).count() == 0


class TestToxicity:
    BAD = ["idiotic", "moronics", "scumbags", "trashyish"]

    def corpus(self, spark, n=900):
        rnd = random.Random(4)
        plain = [f"{a}{b}{c}" for a in ("ba", "lo", "mi", "tu") for b in ("ren", "dol", "kas") for c in ("a", "in", "os", "um", "el")]
        rows, labels = [], []
        for i in range(n):
            toxic = i % 5 == 0
            text = [rnd.choice(plain) for _ in range(rnd.randint(20, 80))]
            if toxic:
                for _ in range(rnd.randint(2, 5)):
                    text.insert(rnd.randint(0, len(text)), rnd.choice(self.BAD))
            rows.append((i, " ".join(text)))
            labels.append((i, int(toxic)))
        rows += [(10_000, None), (10_001, ""), (None, "idiotic moronics idiotic scumbags"), (3, rows[3][1])]
        labels += [(None, 1), (5, None)]
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")

    def test_held_out_rows(self, spark):
        docs, labels = self.corpus(spark)
        rows = toxicity.judged(docs, labels).collect()
        assert len(rows) == docs.count()
        held = [r for r in rows if r.held_out]
        assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
        assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held if r.doc_id < 10_000) / len(held) > 0.97
        by_id = {r.doc_id: r for r in rows}
        assert by_id[None].predicted == 1 and by_id[10_000].score == by_id[10_001].score < 0.5
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
        assert toxicity.keep_clean(docs, labels).columns == docs.columns

    def test_automaton_against_edit_distance(self):
        terms = [toxicity.Term(b"stupid", True, 2.0), toxicity.Term(b"idiot", True, 2.0), toxicity.Term(b"vequ", False, 2.0), toxicity.Term(b"ass", True, 2.0)]
        automaton = toxicity.Automaton(terms)

        def within_one(a, b):
            if abs(len(a) - len(b)) > 1:
                return False
            i = 0
            while i < min(len(a), len(b)) and a[i] == b[i]:
                i += 1
            return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]

        rnd = random.Random(1)
        words = [b"ass", b"asx", b"vequilo", b"vequ", b"vexu", b"veq"]
        for t in (b"stupid", b"idiot"):
            for _ in range(150):
                w = bytearray(t)
                for _ in range(rnd.randint(0, 2)):
                    at = rnd.randint(0, len(w) - 1)
                    rnd.choice([lambda: w.__setitem__(at, rnd.randint(97, 122)), lambda: w.insert(at, rnd.randint(97, 122)), lambda: w.pop(at)])()
                words.append(bytes(w))
        data = np.frombuffer(b" ".join(words), dtype=np.uint8)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        got = automaton.read(data, ends - [len(w) for w in words], ends)
        for w, label in zip(words, got, strict=True):
            if w.startswith(b"vequ"):
                want = 4
            elif w == b"ass":
                want = 6
            else:
                want = next((2 * k + (w != t) for k, t in enumerate((b"stupid", b"idiot")) if within_one(w, t)), -1)
            assert label == want, w

    def test_an_edit_is_a_letter(self):
        terms = [toxicity.Term("größe".encode(), True, 2.0), toxicity.Term("дурак".encode(), True, 2.0), toxicity.Term("naïf".encode(), True, 2.0)]
        words = ["größe", "große", "grße", "дурак", "дурлк", "дрк", "naïf", "naif", "дур\U0001f600к", "x"]
        scorer = toxicity.Scorer(terms)
        raw = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
        got = scorer.finds(raw, np.array([0, len(raw)]))[-1].tolist()
        assert got == [0, 1, 1, 2, 3, -1, 4, -1, 3, -1]  # a word of four letters is not bent
        letters, number = toxicity.letters_of(raw)
        assert "".join(map(chr, letters)) == " ".join(words) and number[-1] == len(letters)

    def test_a_repeated_identifier_is_learned_from_once(self, spark):
        rows = [(k, f"fine words {k}") for k in range(30)] + [(100, "vile vile")] * 50 + [(101 + k, f"vile {k}") for k in range(20)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        labels = spark.createDataFrame([(i, int(i >= 100)) for i in {i for i, _ in rows}], "doc_id long, toxic int")
        once = spark.createDataFrame(sorted(set(rows)), "doc_id long, text string")
        a, b = toxicity.learned(docs, labels), toxicity.learned(once, labels)
        assert (a.weights == b.weights).all() and np.allclose(a.model, b.model)

    def test_inflected_words_may_be_misspelled(self):
        forms = {"stupid": 300, "stupidity": 40}
        toxic = {w.encode() + b"\x00": n for w, n in forms.items()} | {b"stup": 340, b"stupi": 340, b"stupid": 40, b"stupidi": 40, b"stupidit": 40}
        terms = toxicity.choose_terms(toxic, {}, 1000, 5000)
        words = [b"stupid", b"stupidity", b"stupids", b"stpid", b"s7upid", b"sttupid", b"tupid", b"stopidity", b"other"]
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        got = toxicity.Automaton(terms).read(np.frombuffer(b" ".join(words), dtype=np.uint8), ends - [len(w) for w in words], ends)
        assert (got[:-1] >= 0).all() and got[-1] == -1

    def test_no_telling_term_is_cut(self, spark, monkeypatch):
        names = [f"{a}{b}{c}bad".encode() for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
        terms = toxicity.choose_terms({n + b"\x00": 50 for n in names}, {}, 1000, 5000)
        assert sorted(t.text for t in terms) == sorted(names)  # 600 terms
        monkeypatch.setattr(toxicity, "TABLE_TERMS", 7)
        some = [toxicity.Term(t.text, t.whole, 1.0 + k % 5) for k, t in enumerate(terms[:40])]
        words = [t.text for t in some] + [t.text[1:] for t in some] + [b"other"]
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        place = np.frombuffer(b" ".join(words), dtype=np.uint8), ends - [len(w) for w in words], ends
        assert (toxicity.Automata(some).read(*place) == toxicity.Automaton(some).read(*place)).all()

        common = spark.range(60_000).selectExpr("cast(concat('common', id) as binary) AS term", "100L AS n")
        rare = spark.createDataFrame([(bytearray(b"rarebad\x00"), 16)], "term binary, n long")
        found = toxicity.telling(common.unionByName(rare), common, 8000, 8000, 60_001).collect()
        assert [(bytes(r.term), r.n, r.c) for r in found] == []  # 16 of 60,001 at even odds is too little
        found = toxicity.telling(common.unionByName(rare), common, 2000, 8000, 60_001).where("c = 0").collect()
        assert [(bytes(r.term), r.n, r.c) for r in found] == [(b"rarebad\x00", 16, 0)]

    def test_quoted_finds_count_less(self):
        scorer = toxicity.Scorer([toxicity.Term(b"idiot", True, 5.0)])
        feature = lambda t: scorer.features(np.frombuffer(t.encode(), dtype=np.uint8), np.array([0, len(t.encode())]))[0, 0]
        bare = feature("what an idiot he is today they think")
        assert feature('what an "idiot" he is today they think') < bare
        assert feature("what the word idiot he is today they think") < bare
        assert feature("you are an idiot idiot he is today they think") > bare

    def test_no_labels_and_empty(self, spark, no_docs):
        none = spark.createDataFrame([], "doc_id long, toxic int")
        docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
        assert [(r.score, r.predicted) for r in toxicity.judged(docs, none).collect()] == [(0.0, 0)]
        assert toxicity.judged(no_docs, none).count() == 0

    def test_logistic_fit(self):
        rnd = np.random.default_rng(0)
        x = rnd.normal(size=(2000, 2))
        y = (rnd.random(2000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0])))).astype(float)
        beta = toxicity.fit_logistic(x, y)
        assert math.isclose(beta[1], 2, abs_tol=0.25) and abs(beta[2]) < 0.2
