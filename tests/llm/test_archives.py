"""Archives written and read back in splits, against the pages themselves."""

import base64
import gzip
import hashlib
import random
import zlib

import pytest

from lakeops.llm import warc

SCHEMA = "page_id bigint, url string, html string, body binary, path string"


def expected(rows):
    """The contract in plain Python; equal rows and null ids as the module defines them."""
    payload = [(r[0], (r[2] or "").encode()) for r in rows]
    best = {}
    for k, p in payload:
        if k is not None and (best.get(p) is None or k > best[p]):
            best[p] = k
    out = []
    for k, p in payload:
        again = best.get(p) is not None and k != best[p]
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((k, len(p), digest, "revisit" if again else "response", best[p] if again else None))
    return sorted(out, key=repr)


def edges():
    pick = random.Random(4)
    noise = "".join(chr(pick.randint(0x20, 0x2FFF)) for _ in range(60_000))
    rows = [(i, f"https://example.org/{i % 7}", "same page" if i % 3 == 0 else f"page {i % 40} " * (i % 50), None, "x") for i in range(300)]
    rows += [(None, None, None, None, None), (None, "u", "same page", None, None), (500, "a b\r\nX: y", "", None, None)]
    rows += [(600, "http://é/", noise, None, None), (601, "v", "\r\n\r\nWARC/1.1\r\n\r\n\x1f", None, None)]
    return rows + rows[3:9]


@pytest.mark.parametrize("split_bytes", [257, 4096, 1 << 26])
def test_round_trip(spark, split_bytes):
    rows = edges()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = warc.archive_round_trip(pages, split_bytes=split_bytes, file_bytes=20_000)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_empty_table_and_text_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.archive_round_trip(empty).count() == 0
    rows = [("a/b %é", "u", "x"), ("<z>", "u", "x"), (None, "u", "y")]
    found = warc.archive_round_trip(spark.createDataFrame(rows, "page_id string, url string, html string"))
    assert {(r.page_id, r.record_type, r.refers_to) for r in found.collect()} == {
        ("a/b %é", "response", None), ("<z>", "revisit", "a/b %é"), (None, "response", None)
    }


def test_short_payloads_are_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    found = warc.archive_round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string"), smallest=3)
    assert {r.page_id: r.refers_to for r in found.collect()} == {1: None, 2: None, 3: 4, 4: None}


def test_files_are_plain_archives(spark, fresh):
    rows = [(i, "https://example.org/", "page " * i) for i in range(30)]
    files = warc.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string"), fresh("w")).collect()
    assert sum(f.records for f in files) == 30
    texts = [gzip.open(f.path, "rb").read() for f in files if f.records]
    assert sum(t.count(b"WARC/1.1\r\nWARC-Type: response\r\n") for t in texts) == 30


def nested(n):
    """A payload that stores an archive of its own, which cannot be compressed further."""
    return b"".join(warc.record("response", f'{{"id":{i}}}', "u", random.Random(i).randbytes(900), "D", None, "d") for i in range(n))


def stored(member):
    """The same record without compression, as a writer may do for what does not shrink."""
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    return pack.compress(gzip.decompress(member)) + pack.flush()


@pytest.mark.parametrize("split_bytes", [700, 5_000])
def test_archives_inside_payloads_are_not_read(spark, fresh, split_bytes):
    """Ranges that start inside a stored archive are put right by their neighbours."""
    folder = fresh("nested")
    store, base = warc.open_store(folder)
    store.create_dir(base, recursive=True)
    parts = [
        stored(warc.record("response", f'{{"id":{1000 + i}}}', "u", nested(60) if i % 2 else b"plain " * 50, "D", None, "d")) for i in range(6)
    ]
    parts.insert(4, b"damaged \x1f\x8b\x08 stretch" * 40)
    with store.open_output_stream(f"{base}/a.warc.gz", compression=None) as out:
        out.write(b"".join(parts))
    files = warc.archive_files(spark, [f"{folder}/a.warc.gz"])
    inner = warc.Source(store.open_input_file(f"{base}/a.warc.gz"), files.first()["bytes"])
    assert warc.next_member(inner, len(parts[0]) + 100, 1 << 30) < len(parts[0]) + len(parts[1])  # there is one to mistake
    found = warc.read_archives(files, split_bytes).collect()
    want = [f"<urn:lakeops:%7B%22id%22%3A{1000 + i}%7D>" for i in range(6)]
    assert [r.record_id for r in sorted(found, key=lambda r: r.offset)] == want
    assert all(len(r.body) == int(r.headers["content-length"]) for r in found)


def test_damage_at_the_start_and_the_end(spark, fresh):
    folder = fresh("damaged")
    store, base = warc.open_store(folder)
    store.create_dir(base, recursive=True)
    good = [warc.record("response", f'{{"id":{i}}}', "u", b"x" * 3000, "D", None, "d") for i in range(20)]
    with store.open_output_stream(f"{base}/a.warc.gz", compression=None) as out:
        out.write(b"junk" * 50 + b"".join(good) + good[0][:-20])
    found = warc.read_archives(warc.archive_files(spark, [f"{folder}/a.warc.gz"]), 300).collect()
    assert len(found) == 20 and len({r.offset for r in found}) == 20
