"""Collocations against counts in plain Python, with tables too small for the vocabulary."""

import collections
import random
import re

import numpy as np
import pytest

from lakeops.llm import collocations as C

MARKS = ".,;:!?\n\r\x0b\x0c"


def expected(rows, max_words, min_count, top, percent):
    f, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(f"[{MARKS}]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for size in range(1, max_words + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    often = {k: n for k, n in f.items() if n >= min_count}
    inside = collections.Counter()
    for (lang, words), n in often.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    inside[lang, words[i:j]] = max(inside[lang, words[i:j]], n)
    scored = collections.defaultdict(list)
    for (lang, words), a in often.items():
        if len(words) < 2 or ((lang, words) in inside and 100 * inside[lang, words] >= percent * a):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        scored[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {
        (lang, i, p.decode(), -a, l, r, total[lang], -s)
        for lang, found in scored.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


def corpus():
    pick = random.Random(6)
    words = ["the", "The", "of", "new", "york", "city", "é", "İs", "日本", "a" * 300, *(f"w{i}" for i in range(60))]
    weights = [60, 10, 40, 20, 20, 15, 8, 8, 8, 2, *([3] * 60)]
    def text():
        out = []
        for w in pick.choices(words, weights, k=pick.choice([0, 3, 80, 400])):
            out.append(w)
            out.append(pick.choice([" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", " new york city "]))
        return "".join(out)
    rows = [(pick.choice(["en", "en", "de", None, "xx"]), text()) for _ in range(120)]
    return rows + rows[:30] + [("en", None), (None, ""), ("zz", "..."), ("en", "new york " * 500), ("fr", "nospace" * 900)]


@pytest.mark.parametrize("max_words, table, buffer", [(3, C.TABLE, 1 << 20), (3, 12, 50), (4, 6, 64), (4, 40, 1 << 20), (2, 1, 200)])
def test_against_plain_python(spark, monkeypatch, max_words, table, buffer):
    rows = corpus()
    counts = C.phrase_counts
    monkeypatch.setattr(C, "phrase_counts", lambda *a: counts(*a, buffer=buffer))
    docs = spark.createDataFrame([(i, *r, "p", 1) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string, phrase string, n int").repartition(3)
    found = C.collocations(docs, max_words, 10, 50, table=table)
    assert set(map(tuple, found.collect())) == expected(rows, max_words, 10, 50, 50)


def test_slices_do_not_cut_words():
    text = ("alpha,beta  gamma\n" * 40 + "x" * 100 + " end").encode()
    whole = [t for some in C.tokens(text) for t in some]
    for size in (1, 7, 64):
        assert [t for some in C.tokens(text, size) for t in some] == whole


def test_tiles_add_up(monkeypatch):
    monkeypatch.setattr(C, "BUFFER", 1000)
    monkeypatch.setattr(C, "DENSE_FROM", 50)
    monkeypatch.setattr(C, "MOST_DENSE", 2)
    pick, want, got = np.random.default_rng(3), collections.Counter(), collections.Counter()
    tiles = C.Tiles()
    for i in range(60):
        row, column = pick.zipf(1.3, 300) % C.TABLE, pick.zipf(1.3, 300) % C.TABLE
        codes = C.packed(i % 3, row, column)
        assert (C.unpacked(codes)[1] == row).all() and (C.unpacked(codes)[2] == column).all()
        want.update(codes.tolist())
        parts = list(tiles.add(codes))
        for spread, n in parts + (list(tiles.rest()) if i == 59 else []):
            assert (np.diff(spread.astype(object)) > 0).all()
            back = (spread * np.uint64(C.UNSPREAD)).astype(np.int64)
            got.update(dict(zip(back.tolist(), n.tolist())))
    assert got == want


def test_lists_are_cut_by_words_not_by_tasks(spark, monkeypatch):
    rows = [("en", " ".join(f"w{(i * k) % 90}" for k in range(60))) for i in range(400)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string").repartition(40)
    made = spark.sparkContext.accumulator(0)
    count = C._count_phrases

    def counted(*a):
        work = count(*a)

        def run(batches):
            for lists in work(batches):
                made.add(lists.num_rows)
                yield lists

        return run

    monkeypatch.setattr(C, "_count_phrases", counted)
    assert set(map(tuple, C.collocations(docs, 3, 10, 50).collect())) == expected(rows, 3, 10, 50, 50)
    assert 80 <= made.value <= 160  # a list or two per task and length; before, one per bucket of every shuffle partition
    assert C.bucket_count(0, 8) == 1 and C.bucket_count(3 * C.BUCKET_WORDS, 8) == 3 and C.bucket_count(10**12, 8) == 64


def test_scores_beyond_64_bits(spark):
    pick = random.Random(1)
    rows = [(a, pick.randint(a, 10**14), pick.randint(a, 10**14)) for a in (pick.randint(10, 10**13) for _ in range(300))]
    rows += [(10**14, 10**14, 10**14), (10, 10**14, 10**14)]
    df = spark.createDataFrame(rows, "a bigint, l bigint, r bigint")
    from pyspark.sql import functions as F

    for r in df.withColumn("s", C.exact_score(F.col("a"), F.col("l"), F.col("r"))).collect():
        assert r.s == 1_000_000 * r.a * r.a // (r.l * r.r)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "doc_id bigint, lang string, text string")).count() == 0
