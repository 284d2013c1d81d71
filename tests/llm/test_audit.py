"""The filter audit against the five conditions in plain Python."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from lakeops.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = WORD.findall(text)
    return (
        len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)),
    )


def buffer(texts):
    raw = [t.encode() for t in texts]
    return b"".join([*raw, bytes(8)]), np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_scan(size):
    pick = random.Random(size)
    long = ["abcdefgh1", "abcdefgh2", "abcdefgh1x" * 3, "abcdefgh1x" * 3 + "y", "é" * 40]
    for trial in range(150):
        texts = ["".join(pick.choice("abAB \t\n#é日\U0001f600 ") for _ in range(pick.choice([0, 0, 1, 5, 40, 300]))) for _ in range(pick.randint(0, 12))]
        if trial % 4 == 0:
            texts.append(" ".join(pick.choice(long) for _ in range(50)))
        found = audit.scan(*buffer(texts), size)
        assert [tuple(int(f[i]) for f in found) for i in range(len(texts))] == [measures(t) for t in texts]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(audit.WordTable, "hashed", lambda self, doc, start, length, head: np.zeros(len(doc), np.uint64))
    texts = ["a b a longword1 longword2 longword1", "a a", "x " * 3 + "longwordlongword1 longwordlongword2"]
    assert audit.scan(*buffer(texts))[1].tolist() == [4, 1, 3]


def expected(rows, labels):
    smallest, good, toxic = {}, collections.Counter(), collections.Counter()
    for k, text, _ in rows:
        if k is not None:
            smallest[text or ""] = min(smallest.get(text or "", k), k)
    for k, quality, bad in labels:
        good[k] |= quality == 1
        toxic[k] |= bad == 1
    docs = []
    for k, text, part in rows:
        words, distinct, points, capitals, symbols = measures(text or "")
        fails = {
            f for f, x in zip("ABCDE", (
                words < 100, 100 * distinct < 80 * words, 100 * capitals > 10 * points, symbols > 0,
                k is not None and k > smallest[text or ""],
            )) if x
        }
        docs.append((part or "", fails, k is not None and good[k], k is not None and toxic[k]))
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    out, shapley = {}, collections.Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in orders:
            for step, f in enumerate(order, 1):
                gone = [d for d in own if d[1] & set(order[: step - 1])]
                here = [d for d in own if f in d[1] and not d[1] & set(order[: step - 1])]
                shapley[part, f] += len(here)
                out[part, order, step] = [
                    len(own) - len(gone) - len(here), len(here), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in own),
                    sum(bool(d[2]) for d in here), sum(bool(d[3]) for d in here),
                ]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_audit(spark):
    pick = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)] + ["Big", "a#b", "$"]
    texts = [" ".join(pick.choice(vocabulary[: pick.choice([20, 400, 403])]) for _ in range(pick.choice([20, 120]))) for _ in range(40)]
    texts += [None, "", "X" * 3000, "x " * 150, "日本 " * 120]
    rows = [(pick.choice([None, *range(60)]), pick.choice(texts), pick.choice(["en", "de", None, ""])) for _ in range(300)]
    rows += rows[:20]
    labels = [(k, pick.choice([0, 1, None]), pick.choice([0, 1])) for k in [*range(50), *range(10), None]]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, lang string, failed int, label_id int")
    found = audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found.collect()}
    assert got == expected(rows, labels)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert audit.filter_audit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 0
