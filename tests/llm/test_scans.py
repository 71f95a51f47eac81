"""Licences, periodic runs and resampling, as operators and as registered queries, against plain Python."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from tickloom.llm import licenses, periodic_runs, queries, resampling

WHITE_WORD = r"[^\x20\x09-\x0D]+"
LOW_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def low_words(text):
    return re.findall(LOW_WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(spark, folder, **tables):
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


# 11 licences


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        past, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            past, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, past + (x != y))
    return row[-1]


def notices_by_hand(text):
    """(phrase, first word, past word, edits) by comparing every stretch of words with every phrase."""
    words = low_words(text)
    kept = []
    for notice in licenses.NOTICES:
        size, most = len(notice.phrase), len(notice.phrase) // 10
        found = []
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                held = " ".join(words[i:j])
                if len(held) > size + most:
                    break
                if len(held) >= size - most and set(notice.keys) <= set(words[i:j]):
                    distance = edits(notice.phrase, held)
                    if distance <= most:
                        found.append((distance, len(" ".join(words[:i])), len(held), i, j))
        chosen = []
        for f in sorted(found):
            if f[0] == 0 or all(f[4] <= c[3] or c[4] <= f[3] for c in chosen):
                chosen.append(f)
        kept += [(notice.phrase, i, j, e) for e, _, _, i, j in chosen]
    return sorted(kept)


def licence_texts():
    draw = random.Random(11)
    texts = [n.phrase for n in licenses.NOTICES]
    for notice in licenses.NOTICES:
        for changes in (1, 2, 3, len(notice.phrase) // 10, len(notice.phrase) // 10 + 1):
            chars = list(notice.phrase)
            for _ in range(changes):
                at = draw.randrange(len(chars))
                chars[at : at + 1] = draw.choice([[], [draw.choice("abcdxyz ")], [chars[at], draw.choice("abcdxyz ")]])
            texts.append(f"Some words before, THEN {''.join(chars)}. and after; under the licence")
    more = [
        None, "", " \t ", "CC-BY-NC", "cc by nc cc by nc by nc", "Under the MIT license, under\nthe (mit) License", "under the m.i.t. license", "únder the mit license",
        "apache license version 1.1", "Apache Licence, Version 2.0", "under the bsd license", "é\x85the mit license under the mit licénse", "all all rights reserved reserved",
        "mit license " * 40, "under the mit licence " * 30,
    ]
    return texts + more


def test_notices_against_every_stretch(spark):
    texts = licence_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["f"] for r in docs.select("doc_id", licenses.find(docs["text"]).alias("f")).collect()}
    for i, text in enumerate(texts):
        assert got[i]["n_words"] == len(low_words(text))
        spans = got[i]["spans"]
        assert sorted((s["phrase"], s["first_word"], s["past_word"], s["errors"]) for s in spans) == notices_by_hand(text), text
        for s in spans:
            assert low_words(text[s["first"] : s["past"]]) == low_words(text)[s["first_word"] : s["past_word"]]
    assert [s["label"] for s in got[texts.index("Apache Licence, Version 2.0")]["spans"]] == ["apache-2"]
    assert not got[texts.index("apache license version 1.1")]["spans"]


def test_licence_query(spark, tmp_path):
    base = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    texts = licence_texts()
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, labels string, n_words int")
    folder = written(spark, tmp_path, documents=docs.unionAll(docs.limit(5)))
    got = queries.op11_licenses(spark, folder).collect()
    assert len(got) == len(texts) + 5
    for r in got:
        words = low_words(texts[r["doc_id"]])
        places = [(i, label) for p, label in base.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(r["labels"]) and (not places or r["score"] == 1)


def test_licences_in_the_tables_are_found(spark, tables):
    found = queries.op11_licenses(spark, tables).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()}
    marks = {"MIT License": "mit", "Apache License": "apache-2", "CC BY-NC": "cc-by-nc", "GNU General Public License": "gpl", "All rights reserved": "proprietary"}
    for r in found:
        assert r["labels"] == ",".join(sorted({label for mark, label in marks.items() if mark in (texts[r["doc_id"]] or "")}))


# 12 periodic runs


def runs_by_hand(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_cases():
    draw = random.Random(12)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    cases = [[], ["x"], ["x"] * 11, ["x"] * 12, ["x"] * 500, list("ab" * 6), list("ab" * 5 + "a"), list("abc" * 40 + "d" + "abc" * 40), list(fibonacci[-1]), list("abcdefghijklm" * 2)]
    cases += [list("a" * 9 + "b") * 9, list("a" * 40 + "b") * 2, list("ab" * 9 + "b") * 5 + list("ab" * 30)]
    for size, letters in itertools.product((30, 90, 400), ("ab", "abc", "abcdefgh")):
        for _ in range(12):
            case = draw.choices(letters, k=size)
            for _ in range(3):
                at, length = draw.randrange(size), draw.randint(1, size // 2)
                root = case[at : at + draw.randint(1, size // 4)]
                case[at : at + length] = (root * length)[:length]
            cases.append(case)
    return cases


@pytest.mark.parametrize("least", [2, 5, 12, 40])
def test_runs_against_every_lag(least):
    cases = periodic_cases()
    letters = {w: i for i, w in enumerate(sorted({w for c in cases for w in c}))}
    sizes = np.array([len(c) for c in cases])
    words = np.array([letters[w] for c in cases for w in c])
    got = periodic_runs.find_runs(words, sizes, least)
    starts = np.cumsum(sizes) - sizes
    expected = [(int(s) + a, int(s) + b, q) for s, c in zip(starts, cases) for a, b, q in runs_by_hand(c, least)]
    assert got == sorted(expected, key=lambda r: (r[0], r[2]))


def test_short_binary_words_have_all_their_runs():
    cases = list(itertools.product((0, 1), repeat=13))
    got = periodic_runs.find_runs(np.array(cases).ravel(), np.full(len(cases), 13), 4)
    assert got == sorted(((13 * i + a, 13 * i + b, q) for i, c in enumerate(cases) for a, b, q in runs_by_hand(c, 4)), key=lambda r: (r[0], r[2]))


def test_long_periodic_documents_stay_cheap():
    sizes = np.array([300_000, 300_000, 200_000])
    words = np.concatenate([np.zeros(300_000, int), np.arange(300_000) % 70_001, np.arange(200_000) % 2 + np.arange(200_000) // 99_999 % 2])
    runs = periodic_runs.find_runs(words, sizes)
    assert (0, 300_000, 1) in runs and (300_000, 600_000, 70_001) in runs
    # the seeds of an octave are about as many as the words, though one gram fills the document
    grams = periodic_runs._Grams(np.zeros(100_000, int), np.zeros(100_000, int))
    for low, high, gram, stride in periodic_runs._octaves(100_000, 12):
        while grams.size < gram:
            grams.double()
        assert len(grams.seeds(np.flatnonzero(grams.places % stride == 0), low, high)[0]) <= 2.5 * 100_000


def test_periodic_query(spark, tmp_path, odd_docs):
    draw = random.Random(3)
    rows = [(1000 + i, " ".join(draw.choices("ab cd ef\tgh\n".split(" "), k=draw.randint(0, 300))), "k", 1) for i in range(150)]
    folder = written(spark, tmp_path, documents=odd_docs.unionAll(spark.createDataFrame(rows, odd_docs.schema)))
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = []
    for doc_id, text in texts:
        words = re.findall(WHITE_WORD, text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = runs_by_hand(words) if n < 20_000 else [(0, n, 2)]
        gone = set().union(*(range(a + q, b) for a, b, q in runs))
        best = min(((a - b, a, q) for a, b, q in runs), default=None)
        expected.append((
            doc_id, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
            sha("".join(f"{a},{b - a},{q}\n" for a, b, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        ))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(r[c] for c in names) for r in queries.op12_periodic(spark, folder).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert sum(e[1] > 0 for e in expected) > 10


# 13 resampling


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_gram_crcs(longest):
    draw = random.Random(longest)
    words = [b"a", b"bc", "épée".encode(), b"x" * 300, b"y" * 70_000, b"word"]
    texts = [draw.choices(words, k=draw.randint(0, 12)) for _ in range(40)] + [[], []]
    crcs, homes = resampling.gram_crcs(texts, longest)
    got = collections.Counter(zip(homes.tolist(), crcs.tolist()))
    grams = ((i, t[j : j + n]) for i, t in enumerate(texts) for n in range(1, longest + 1) for j in range(len(t) - n + 1))
    assert got == collections.Counter((i, zlib.crc32(b" ".join(g))) for i, g in grams)


@pytest.mark.parametrize("longest, percent", [(1, 10), (2, 50)])
def test_resampling_by_hand(spark, odd_docs, longest, percent):
    bench = spark.createDataFrame([(1, "w5 w6 Alpha"), (2, None), (3, "long words, long"), (4, "")], "item_id long, text string")
    rows = [(r["doc_id"], r["text"], r["n_words"]) for r in odd_docs.collect()]

    def grams(text):
        w = low_words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 500 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s = collections.Counter(b for _, t, _ in rows for b in grams(t))
    t = collections.Counter(b for r in bench.collect() for b in grams(r["text"]))
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 500) / ((s[b] + 1) * (all_t + 500)))) for b in range(500)]
    expected = []
    for doc_id, text, other in rows:
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in grams(text))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        expected.append([doc_id, other, len(low_words(text)), len(grams(text)), weight, score, None])
    able = sorted((e for e in expected if e[2] >= 20), key=lambda e: (-e[5], math.inf if e[0] is None else e[0]))
    for i, e in enumerate(able[: len(able) * percent // 100]):
        e[6] = i + 1
    drawn = resampling.resample(odd_docs, bench, longest=longest, percent=percent, buckets=500, seed=7)
    got = [(r["row"]["doc_id"], r["row"]["n_words"], *r[1:]) for r in drawn.collect()]
    assert sorted(got, key=repr) == sorted(map(tuple, expected), key=repr)


def test_nothing_to_resample(spark, odd_docs, no_docs):
    assert resampling.resample(no_docs, odd_docs).count() == 0
    drawn = resampling.resample(odd_docs, no_docs)
    assert drawn.count() == odd_docs.count() and drawn.filter("rank is not null").count() > 0
