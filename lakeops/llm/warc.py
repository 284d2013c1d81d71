"""WARC archives: writing pages with revisit records, and reading them back in splits.

The writer gives every record its own gzip member, rolls files at a size, and lists the
files it has finished in a table; what a lost or repeated task left behind is in no
list and is never read.  Of pages with equal payloads the one with the largest id is
a response and the others revisit it: they hold the head of the response and its
digest only.

The reader cuts files into byte ranges.  A task looks for gzip magic in its range,
takes a candidate for a member only if it inflates to a WARC head, and then goes from
member to member; it owns the records that start inside its range and reads beyond the
end of the range to finish the last.  Stored payloads can hold archives of their own,
whose members look as real as the outer ones.  The ranges are therefore checked
against each other: the chain of one range has to arrive where the next begins.  A
range that started elsewhere is started anew where the chain arrives, until all fit.

Defined results: a null payload is empty; equal rows (id and payload) are each a
response; a null id is smaller than any other and is written without an id; a null URL
is left out; control characters in ids and URLs are percent-encoded; damaged stretches
are passed over up to the next member that can be read; an empty table gives no
archive and an empty result; very long payloads are inflated in pieces and held once,
as the record they belong to; other columns are ignored.

Files are reached through Arrow's file systems, as URIs of the shared folder.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.session import materialise, new_dir

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 1 << 30
SPLIT_BYTES = 1 << 26
BLOCK = 1 << 20
FEED = 1 << 14
LONGEST_HEAD = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HOT_PARTS = 1000


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, for a URI or an absolute path."""
    return pafs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(key: str) -> str:
    return f"<urn:lakeops:{urllib.parse.quote(key, safe='')}>"


def record(kind: str, key: str | None, url: str | None, payload: bytes, digest: str, refers: str | None, date: str) -> bytes:
    """One record as a gzip member; the date is a parameter so that archives are reproducible."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    head.append(f"WARC-Record-ID: {_urn(key)}" if key is not None else f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}>")
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="".join(map(chr, range(0x21, 0x7F)))))
    if kind == "revisit":
        head.append(f"WARC-Profile: {PROFILE}")
        if refers is not None:
            head.append(f"WARC-Refers-To: {_urn(refers)}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + body + b"\r\n\r\n") + pack.flush()


def with_first_holder(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Adds ``holder``, the largest id of an equal payload, to ``id, url, payload``; null for short payloads.

    Payloads meet by digest after each task has reduced its own.  A payload that holds
    more than a thousandth of all rows is one of at most a thousand: those are
    broadcast, and their rows take keys of their own in the join of the rest.
    """
    hashed = pages.withColumn("digest", F.sha1("payload"))
    held = hashed.where(F.length("payload") >= smallest).groupBy("digest").agg(
        F.max("id").alias("holder"), F.count(F.lit(1)).alias("n")
    )
    held = materialise(held, "warc-payloads")
    total = held.agg(F.sum("n")).first()[0] or 0
    hot = held.where(F.col("n") * HOT_PARTS > total).select(F.col("digest").alias("_d"), F.col("holder").alias("hot_holder"), F.lit(True).alias("hot"))
    rest = held.where((F.col("n") > 1) & (F.col("n") * HOT_PARTS <= total)).select(F.col("digest").alias("_k"), F.col("holder").alias("other_holder"))
    marked = hashed.join(F.broadcast(hot), F.col("digest") == F.col("_d"), "left")
    # most payloads stand once; a key is only needed where another row may have the same
    key = F.when(F.col("hot"), F.concat(F.lit(" "), F.xxhash64("id", "url").cast("string"))).otherwise(F.col("digest"))
    joined = marked.withColumn("key", key).join(rest, F.col("key") == F.col("_k"), "left")
    alone = F.when(F.length("payload") >= smallest, F.col("id"))
    return joined.select("id", "url", "payload", F.coalesce("hot_holder", "other_holder", alone).alias("holder"))


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    smallest: int = 0,
    file_bytes: int = FILE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes ``*.warc.gz`` below ``folder`` and returns the list of finished files: ``path, bytes, records``.

    Payloads under ``smallest`` bytes are always responses.
    """
    slim = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        done, out, name, size, count = [], None, "", 0, 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((f"{folder.rstrip('/')}/{name}", size, count))
                out = None

        try:
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("key", "holder", "again", "url", "payload"))
                for key, other, again, url, payload in zip(*columns):
                    if out is None:
                        name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    data = record(
                        "revisit" if again else "response", key, url, payload, payload_digest(payload),
                        other if again else None, date,
                    )
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= file_bytes:
                        close()
            close()
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pydict(
            {"path": [d[0] for d in done], "bytes": [d[1] for d in done], "records": [d[2] for d in done]},
            pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]),
        )

    def text(name: str):
        return F.when(F.col(name).isNotNull(), F.to_json(F.struct(F.col(name).alias("id"))))

    again = F.col("holder").isNotNull() & ~F.col("id").eqNullSafe(F.col("holder"))
    rows = with_first_holder(slim, smallest).select(
        text("id").alias("key"), text("holder").alias("holder"), again.alias("again"), "url", "payload"
    )
    return materialise(rows.mapInArrow(work, "path string, bytes bigint, records bigint"), "warc-files")


class Source:
    """Buffered reading of one file, a block at a time."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def _low(self, at: int, least: int) -> int:
        low = at - self.at
        if low < 0 or low + least > len(self.data):
            self.file.seek(at)
            self.at, self.data, low = at, self.file.read(max(BLOCK, least)), 0
        return low

    def read(self, at: int, n: int) -> bytes:
        """The ``n`` bytes from ``at``, fewer at the end of the file."""
        low = self._low(at, min(n, self.size - at))
        return self.data[low : low + n]

    def find(self, mark: bytes, at: int) -> tuple[int, bool]:
        """Where ``mark`` stands from ``at`` on within the block, or how far it surely does not."""
        low = self._low(at, min(len(mark), self.size - at))
        found = self.data.find(mark, low)
        if found >= 0:
            return self.at + found, True
        return max(at + 1, self.at + len(self.data) - len(mark) + 1), False


def inflate(source: Source, at: int) -> Iterator[tuple[bytes, int | None]]:
    """Pieces of the member that starts at ``at``; with the last, where the member ends."""
    engine = zlib.decompressobj(31)
    while at < source.size:
        data = source.read(at, FEED)
        piece = engine.decompress(data)
        at += len(data) - len(engine.unused_data)
        if engine.eof:
            yield piece, at
            return
        yield piece, None
    raise zlib.error("the file ends inside a member")


def head_of(data: bytes) -> tuple[dict[str, str], int] | None:
    """Fields of a WARC head, by lower-case name, and its length; ``None`` if there is none."""
    end = data.find(b"\r\n\r\n", 0, LONGEST_HEAD)
    if end < 0 or not data.startswith(b"WARC/"):
        return None
    fields = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


def member_at(source: Source, at: int, whole: bool) -> tuple[dict[str, str], bytes, int] | None:
    """Head, body and end of the record that starts at ``at``, or ``None``.

    Without ``whole`` the body is inflated but not kept.
    """
    start = source.read(at, 4)
    if len(start) < 4 or start[:3] != MAGIC or start[3] & 0xE0:
        return None
    head, pieces, seen, end = None, [], b"", None
    try:
        for piece, end in inflate(source, at):
            if head is None:
                seen += piece
                head = head_of(seen)
                if head is None:
                    if not b"WARC/".startswith(seen[:5]) or len(seen) > LONGEST_HEAD:
                        return None
                    continue
                piece = seen[head[1] :]
            if whole:
                pieces.append(piece)
    except zlib.error:
        return None
    if head is None or end is None:
        return None
    return head[0], b"".join(pieces)[: int(head[0]["content-length"])], end


def next_member(source: Source, at: int, stop: int) -> int:
    """The first place from ``at`` and before ``stop`` where a record starts, or ``stop``."""
    while at < stop:
        at, found = source.find(MAGIC, at)
        if found:
            if at < stop and member_at(source, at, whole=False):
                return at
            at += 1
    return stop


def chain(source: Source, start: int, stop: int, whole: bool) -> Iterator[tuple[int, dict[str, str], bytes, int]]:
    """Records that start from ``start`` on and before ``stop``, one behind the other."""
    at = start
    while at < stop:
        found = member_at(source, at, whole)
        if found is None:
            at = next_member(source, at + 1, stop)
            continue
        yield at, *found
        at = found[2]


RANGE = "path string, bytes bigint, part bigint, low bigint, high bigint"


def ranges(files: DataFrame, split_bytes: int) -> DataFrame:
    """One row per byte range, dealt out so that a task reads about one."""
    size = F.col("bytes").cast("bigint")
    low = F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1, F.lit(split_bytes).cast("bigint")))
    cut = files.where("bytes > 0").select("path", size.alias("bytes"), low.alias("low"))
    return cut.select(
        "path", "bytes", (F.col("low") / split_bytes).cast("bigint").alias("part"), "low",
        F.least(F.col("low") + split_bytes, "bytes").alias("high"),
    )


def _dealt(parts: DataFrame) -> DataFrame:
    n = parts.count()
    return parts.repartition(max(1, min(n, 100_000)), "path", "part")


def _each_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Source]]:
    for batch in batches:
        for row in batch.to_pylist():
            store, path = open_store(row["path"])
            with store.open_input_file(path) as file:
                yield row, Source(file, row["bytes"])


def _bounds(parts: DataFrame) -> DataFrame:
    """Where the records of each range begin, and where the chain from there arrives.

    ``start`` is where to begin if that is known, else null: the task then searches.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, source in _each_range(batches):
            first = row["start"] if row["start"] is not None else next_member(source, row["low"], row["high"])
            at = first
            for _, _, _, at in chain(source, first, row["high"], whole=False):
                pass
            # a stretch without a record hands on the end of the range
            yield pa.RecordBatch.from_pylist([{**row, "first": first, "next": max(at, row["high"])}], schema)

    names = ["path", "bytes", "part", "low", "high", "start", "first", "next"]
    schema = pa.schema([(n, pa.string() if n == "path" else pa.int64()) for n in names])
    return _dealt(parts).mapInArrow(work, f"{RANGE}, start bigint, first bigint, next bigint")


def located(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Ranges with the place ``first`` of the first record each owns, checked against its neighbours.

    A range is settled if it begins where the chains before it arrive.  Each round puts
    right at least the earliest wrong range of a file; without damage or archives stored
    inside payloads the first round finds nothing wrong.
    """
    begin = F.when(F.col("low") == 0, F.lit(0)).otherwise(F.lit(None)).cast("bigint")
    found = materialise(_bounds(ranges(files, split_bytes).withColumn("start", begin)), "warc-ranges")
    earlier = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        # a record longer than a range arrives behind several
        arrives = F.max("next").over(earlier)
        due = found.withColumn("due", F.least(F.coalesce(arrives, "first"), "high"))
        wrong = due.where("first <> due")
        if wrong.isEmpty():
            return found
        fixed = _bounds(wrong.select("path", "bytes", "part", "low", "high", F.col("due").alias("start")))
        keep = found.join(wrong.select("path", "part"), ["path", "part"], "left_anti").select(fixed.columns)
        found = materialise(keep.unionByName(fixed), "warc-ranges")


RECORDS = "path string, offset bigint, warc_type string, record_id string, target_uri string, headers map<string,string>, body binary"


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the files ``path, bytes``: place, type, id, URL, all head fields, and the body."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
        names = ["path", "offset", "warc_type", "record_id", "target_uri", "headers", "body"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for row, source in _each_range(batches):
            rows, size = [], 0
            for at, fields, body, _ in chain(source, row["first"], row["high"], whole=True):
                rows.append(
                    (row["path"], at, fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-target-uri"), list(fields.items()), body)
                )
                size += len(body)
                if size >= 1 << 24:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)

    return _dealt(located(files, split_bytes)).mapInArrow(work, RECORDS)


def archive_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The list ``path, bytes`` that the reader takes, for archives written elsewhere."""
    rows = []
    for path in paths:
        store, inner = open_store(path)
        rows.append((path, store.get_file_info(inner).size))
    return spark.createDataFrame(rows, "path string, bytes bigint")


def _id_in(urn: str, name: str, kind: str):
    text = F.regexp_extract(F.col(urn), "^<urn:lakeops:(.*)>$", 1)
    return F.from_json(F.when(text != "", F.url_decode(text)), f"{name} {kind}")[name]


def payload_records(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of records written by :func:`write_archives`.

    A response's digest and length are those of the payload read; a revisit has them in its heads.
    """
    names = ["record_id", "refers", "payload_bytes", "payload_digest", "record_type"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for kind, record_id, headers, body in zip(*(batch.column(c).to_pylist() for c in ("warc_type", "record_id", "headers", "body"))):
                fields = dict(headers)
                http, _, payload = body.partition(b"\r\n\r\n")
                if kind == "response":
                    size, digest = len(payload), payload_digest(payload)
                else:
                    lines = dict(l.lower().split(b": ", 1) for l in http.split(b"\r\n")[1:])
                    size, digest = int(lines[b"content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                rows.append((record_id, fields.get("warc-refers-to"), size, digest, kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if n == "payload_bytes" else pa.string()) for n, c in zip(names, zip(*rows))] if rows
                else [pa.array([], pa.int64() if n == "payload_bytes" else pa.string()) for n in names], names,
            )

    slim = records.select("warc_type", "record_id", "headers", "body")
    read = slim.mapInArrow(work, "record_id string, refers string, payload_bytes bigint, payload_digest string, record_type string")
    return read.select(
        _id_in("record_id", "id", id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        _id_in("refers", "id", id_type).alias("refers_to"),
    )


def archive_round_trip(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    smallest: int = 0,
    split_bytes: int = SPLIT_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes the pages as archives to the shared folder and returns what reading them back gives."""
    folder = new_dir(pages.sparkSession, "warc")
    files = write_archives(pages, folder, id_col, url_col, payload_col, smallest, file_bytes)
    kind = pages.select(F.col(id_col)).schema[0].dataType.simpleString()
    return payload_records(read_archives(files, split_bytes), kind)
