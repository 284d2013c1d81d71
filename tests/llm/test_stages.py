"""The personal-data and mix stages against plain Python alone, on rows that repeat and ids that are missing."""

import collections
import hashlib
import random
import re

import pyspark.sql.functions as F
from brute import WORD, luhn, redacted, targets

import corpus_pipeline
from lakeops.llm import mixing

PERSONAL = [
    "mail a.b@example.org or 10.1.2.3 now", "card 4539 1488 0343 6467 and +1 (017) 555-7713.",
    "IBAN DE89370400440532013000 Please pay", "DE89370400440532013000 EUR 500", "iban GB82 WEST 1234 5698 7654 32 The bank",
    "123-45-6789 (SSN)", "555-123-4567 is my mobile", "call 555-123-4567 or see 555-765-4321", "see 123-45-6789",
    "FR14 2004 1010 0505 0001 3M02 606 2024 DE89370400440532013000", "NO9386011117947 a@b.c", "",
]


def mod97(code):
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def personal(text):
    """``kind:start:end`` of base and added kinds, sorted."""
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9](?:[ -]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    at = 0
    while m := re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}").search(text, at):
        at = m.end()
        for stop in range(m.start() + 15, min(len(text), m.start() + 67) + 1):
            part = text[m.start() : stop]
            code = part.replace(" ", "")
            if (
                re.fullmatch("[A-Z0-9]+(?: [A-Z0-9]+)*", part) and 15 <= len(code) <= 34 and mod97(code)
                and not re.match("[A-Za-z0-9]", text[stop:])
            ):
                out.append((m.start(), 4, "iban", stop))
                at = stop
                break
    labels = (
        (5, "ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", r"\bssn\b|social security|tax id"),
        (6, "local_phone", r"(?<![0-9+)-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", r"phone|\btel\b|call|mobile|fax|cell"),
    )
    for rank, kind, pattern, label in labels:
        for m in re.finditer(pattern, text):
            if any(re.search(label, w.lower()) for w in (text[max(m.start() - 40, 0) : m.start()], text[m.end() : m.end() + 40])):
                out.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def copies_by_row(spark, rows, most=3, seed=17, chunk=1000):
    """(id, source, text) -> how often all rows that are equal to it are in the mix, by walking the whole queue."""
    size = {r: len(WORD.findall(r[2] or "")) for r in rows}
    entries = []
    for (i, source, text), n in collections.Counter(rows).items():
        key = None if text is None else hashlib.md5(text.encode()).digest()
        entries += [(len(entries) + c, i, source, text, key, c, min(chunk, n - c * chunk)) for c in range(-(-n // chunk))]
    kind = "e long, doc_id long, source string, text string, text_hash binary, chunk long, m long"
    hashed = spark.createDataFrame(entries, kind).withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "source", "text_hash", "chunk"))
    total = collections.Counter()
    for r in rows:
        total[r[1]] += size[r]
    want, at, queue = targets(total), collections.Counter(), []
    for e in sorted(hashed.collect(), key=lambda e: e.turn):
        row = (e.doc_id, e.source, e.text)
        for nth in range(1, e.m + 1):
            at[e.source] += size[row]
            for copy in range(most if size[row] else 0):
                queue.append(((at[e.source] + copy * total[e.source]) / want[e.source], e.turn, nth, row))
    taken, words = collections.Counter(), 0
    for _, _, _, row in sorted(queue, key=lambda q: q[:3]):
        words += size[row]
        if words > sum(total.values()):
            break
        taken[row] += 1
    return taken


def fixture(spark):
    pick, rows = random.Random(11), []
    for i in range(160):
        filler = " ".join(pick.choice(("alpha", "beta", "gamma", "delta")) for _ in range(pick.randint(0, 60)))
        rows.append((None if i % 5 == 0 else i, f"{filler} {pick.choice(PERSONAL)}", pick.choice(("a", "b", "c", None))))
    rows += rows[:40] + rows[:7] + [(None, None, "a"), (3, None, None), (None, "", "b"), rows[9], rows[9]]
    rows = [(i, t, s, None if t is None else len(t)) for i, t, s in rows]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(4)


def test_personal_data_stage(spark):
    rows, docs = fixture(spark)
    stage = dict(corpus_pipeline.STAGES)["personal_data"]
    want = collections.Counter()
    for i, text, source, _ in rows:
        clean = redacted(text, personal(text or ""))
        want[i, clean, source, None if clean is None else len(clean)] += 1
    assert collections.Counter(map(tuple, stage(spark, docs, "").collect())) == want
    assert any("<IBAN> Please" in (k[1] or "") for k in want) and any("<LOCAL_PHONE> is my" in (k[1] or "") for k in want)


def test_mix_stage(spark):
    rows, docs = fixture(spark)
    stage = dict(corpus_pipeline.STAGES)["source_mix"]
    copies = copies_by_row(spark, [(r[0], r[2], r[1]) for r in rows])
    got = stage(spark, docs, "").collect()
    assert collections.Counter((r.doc_id, r.source, r.text) for r in got) == copies
    assert {tuple(r) for r in got} <= set(rows)
    assert 0 < sum(copies.values()) < 3 * len(copies)


def test_mix_of_rows_without_ids_and_of_one_row_many_times(spark):
    """A source whose rows share a null id, or are one row, still ends near its target."""
    words = lambda n, k: " ".join(f"w{k}" for _ in range(n))
    others = [(1000 + i, s, words(10, i)) for s in "bc" for i in range(300)]
    for own in ([(None, "a", words(10, i)) for i in range(300)], [(7, "a", words(10, 0))] * 300, [(None, "a", words(5, 0))] * 600):
        rows = own + others
        docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
        report = mixing.mix_report(docs).collect()
        taken = collections.Counter()
        for r in report:
            taken["a" if r.doc_id in (None, 7) else "other"] += r.taken
        assert len(report) == len(rows) and report[0].source_size == 3000
        assert abs(taken["a"] - 5625) <= 10 and abs(taken["other"] - 3375) <= 20
        assert all(r.taken % r["size"] == 0 and r.taken <= 3 * r["size"] for r in report)
        copies = copies_by_row(spark, rows)
        got = collections.Counter((r.doc_id, r.source, r.text) for r in mixing.mixed(docs).collect())
        assert got == copies


def test_entries_of_a_row_that_fills_the_table(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 7)
    monkeypatch.setattr(mixing, "ENTRIES_PER_COPY", 2)
    rows = [(1, "a", "x y z")] * 200 + [(i, "b", "q " * (i % 9)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    copies = copies_by_row(spark, rows, chunk=7)
    got = collections.Counter((r.doc_id, r.source, r.text) for r in mixing.mixed(docs).collect())
    assert got == copies and mixing.mix_report(docs).count() == len(rows)


def test_mix_with_clashing_names_and_long_texts(spark):
    names = "doc_id long, source string, text string, key string, row int, n long, part long, start long, size long, copy int, turn int, m map<string,int>"
    rows = [(i, "ab"[i % 2], "long " * 40_000 if i == 3 else f"t{i} u", "k", 1, 2, 3, 4, 5, 6, 7, {"a": i}) for i in range(20)]
    docs = spark.createDataFrame(rows, names)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and all(tuple(r) in rows for r in got.collect())
