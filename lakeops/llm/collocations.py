"""Phrase collocations by direct-address tiling of frequency-ranked ids.

Words are counted, and the most frequent get ids by their rank within their language.
A pair of ids is a cell of a matrix cut into tiles of 1,024 by 1,024.  In each task a
tile that many occurrences fall into is an array filled by ``bincount``; the others
are sorted coordinate lists with counts.  Tasks send lists of sums per cell, cut into
buckets by a hash of the cell, and the buckets are merged after a shuffle, so a pair
that fills the corpus is one entry per task.  The frequent pairs are then ranked in
turn and stand for the rows of the matrix of triples, and so on up to the longest
phrase: a phrase is the id of its first words and the id of its last.

Tables sent to the tasks are bounded by parameters, whatever the vocabulary: at most
``table`` words and phrases per level, and a bitmap of ``MEMBER_BITS`` that tells
which shorter phrases can be frequent at all.  Phrases beyond the tables are counted
spelled out, in the same pass and just as exactly; the bitmap may only let too many
pass.  Long texts are read in slices cut between words.

Defined results: a null text is empty; a null language is ``und``; repeated rows count
each; A-Z alone are lowered; a text without blanks is one word of any length; ties are
settled by score, count and phrase in byte order; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import materialise

TABLE = 1 << 18  # ids have 18 bits
MEMBER_BITS = 26
RARE, BREAK = -1, -2
SIDE = 10  # a tile has 2 ** SIDE rows and columns
CELLS = 1 << 2 * SIDE
BUFFER, DENSE_FROM, MOST_DENSE = 1 << 20, CELLS // 64, 8
SPELLED = 1 << 17
#: A bucket stands for this many words of the input, so that lists are cut by the amount of text and not by the number of tasks.
BUCKET_WORDS, BUCKETS_PER_PARTITION = 1 << 18, 8
#: An odd factor spreads the codes over 64 bits, its inverse leads back.
SPREAD = 0x9E3779B97F4A7C15
UNSPREAD = pow(SPREAD, -1, 1 << 64)

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
TOKEN = re.compile(rb"[^\x20\x09.,;:!?\x0a-\x0d]+|[.,;:!?\x0a-\x0d]")
EDGE = re.compile(rb"[\x20\x09.,;:!?\x0a-\x0d]")


def tokens(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words and break characters of a text, in slices of about ``size`` bytes cut between words."""
    low, at = text.lower(), 0
    while at < len(low):
        edge = EDGE.search(low, at + size)
        stop = edge.start() if edge else len(low)
        yield TOKEN.findall(low, at, stop)
        at = stop


def _docs(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text")
    )


def _rows(lang: list[str], phrase: list[bytes | None], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
        ["lang", "phrase", "n"],
    )


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, phrase, n`` of every word; the row with a null phrase holds the words of its language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter[bytes]] = {}

        def out() -> pa.RecordBatch:
            rows = []
            for lang, words in seen.items():
                for mark in BREAKS:
                    words.pop(bytes([mark]), None)
                rows.append((lang, None, words.total()))
                rows += [(lang, w, n) for w, n in words.items()]
            seen.clear()
            return _rows(*(list(c) for c in zip(*rows))) if rows else _rows([], [], [])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = seen.setdefault(lang, Counter())
                for some in tokens(text or b""):
                    words.update(some)
                    if sum(map(len, seen.values())) > SPELLED:
                        yield out()
                        words = seen.setdefault(lang, Counter())
        yield out()

    counted = _docs(docs, text_col, lang_col).mapInArrow(work, "lang string, phrase string, n bigint")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def packed(lang: int, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """One number per cell: language, tile and place in the tile, from high bits to low."""
    side = (1 << SIDE) - 1
    tile = (row >> SIDE) << 28 | (column >> SIDE) << 20
    return lang << 36 | tile | (row & side) << SIDE | column & side


def unpacked(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    side = (1 << SIDE) - 1
    row = (code >> 28 & 0xFF) << SIDE | code >> SIDE & side
    return code >> 36, row, (code >> 20 & 0xFF) << SIDE | code & side


def code_bit(code: np.ndarray) -> np.ndarray:
    """Place of a cell in the bitmap of its level."""
    return (code.astype(np.uint64) * np.uint64(SPREAD) >> np.uint64(64 - MEMBER_BITS)).astype(np.int64)


def spelled_bit(lang: str, phrase: bytes) -> int:
    return zlib.crc32(phrase, zlib.crc32(lang.encode())) >> (32 - MEMBER_BITS)


def held(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


@dataclass
class Level:
    """Frequent phrases of one length: codes in order with their ranks, and the bitmap of all."""

    codes: np.ndarray
    ranks: np.ndarray
    bits: np.ndarray
    by_rank: dict[int, np.ndarray] = field(default_factory=dict)

    def rank(self, code: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(code), RARE, np.int64)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], RARE)


@dataclass
class Tables:
    """What tasks need to name phrases: ids of words per language, all frequent words as a bitmap, the levels above.

    ``total`` is the number of all words of the input.
    """

    langs: list[str]
    words: list[list[bytes]]
    bits: np.ndarray
    levels: list[Level] = field(default_factory=list)
    total: int = 0

    def ids(self) -> dict[str, tuple[int, dict[bytes, int]]]:
        marks = {bytes([b]): BREAK for b in BREAKS}
        return {
            lang: (i, {w: k for k, w in enumerate(words)} | marks)
            for i, (lang, words) in enumerate(zip(self.langs, self.words))
        }

    def spell(self, lang: int, code: int, length: int) -> bytes:
        _, row, column = (int(x) for x in unpacked(np.int64(code)))
        first = self.words[lang][row] if length == 2 else self.spell(lang, self.levels[length - 3].by_rank[lang][row], length - 1)
        return first + b" " + self.words[lang][column]


class Tiles:
    """Counts per cell: arrays for crowded tiles, sorted coordinates for the rest.

    What is passed on are spread codes in order, with their counts.
    """

    def __init__(self):
        self.waiting, self.size = [], 0
        self.dense: dict[int, np.ndarray] = {}

    def add(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.waiting.append(codes)
        self.size += len(codes)
        if self.size >= BUFFER:
            yield self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        """Adds what waits to the arrays, and gives back what lies in no crowded tile."""
        codes = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.int64)
        self.waiting, self.size = [], 0
        tiles = codes >> 2 * SIDE
        # every sixteenth tells well enough which tiles are crowded
        some, n = np.unique(tiles[::16], return_counts=True)
        for tile in some[n * 16 >= DENSE_FROM].tolist():
            if len(self.dense) < MOST_DENSE:
                self.dense.setdefault(tile, np.zeros(CELLS, np.int64))
        for tile, cells in self.dense.items():
            inside = tiles == tile
            cells += np.bincount(codes[inside] & (CELLS - 1), minlength=CELLS)
            codes, tiles = codes[~inside], tiles[~inside]
        spread = np.sort(codes.astype(np.uint64) * np.uint64(SPREAD))
        return sums(spread, np.ones(len(spread), np.int64))

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield self.fold()
        for tile, cells in self.dense.items():
            at = np.flatnonzero(cells)
            spread = (at + (tile << 2 * SIDE)).astype(np.uint64) * np.uint64(SPREAD)
            order = np.argsort(spread)
            yield spread[order], cells[at][order]
        self.dense = {}


def sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys, which lie side by side, become one."""
    if not len(keys):
        return keys, n
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def _windows(found: list[bytes], lang: str, number: int, ids: dict[bytes, int], tables: Tables, length: int):
    """Codes of the phrases of ``length`` words that have one, and the places of those that have not.

    A place counts if no break lies in the phrase and both of its parts that are one word
    shorter are among the frequent ones as far as the bitmap tells.
    """
    word = np.fromiter((ids.get(t, RARE) for t in found), np.int64, len(found))
    rank, good = word, word != BREAK
    unnamed = np.flatnonzero(word == RARE)
    if unnamed.size:
        bits = [spelled_bit(lang, found[t]) for t in unnamed.tolist()]
        good[unnamed] = held(tables.bits, np.array(bits, np.int64))
    for size in range(2, length + 1):
        n = len(found) - size + 1
        good = good[:n] & good[1 : n + 1]
        last = word[size - 1 :]
        tiled = good & (rank[:n] >= 0) & (last >= 0)
        code = packed(number, rank[:n][tiled], last[tiled])
        spelled = np.flatnonzero(good & ~tiled)
        if size == length:
            return code, spelled
        level = tables.levels[size - 2]
        good = np.zeros(n, bool)
        good[tiled] = held(level.bits, code_bit(code))
        if spelled.size:
            bits = [spelled_bit(lang, b" ".join(found[t : t + size])) for t in spelled.tolist()]
            good[spelled] = held(level.bits, np.array(bits, np.int64))
        rank = np.full(n, RARE, np.int64)
        rank[tiled] = level.rank(code)


BLOB = pa.schema([("bucket", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary()), ("spelled", pa.binary())])


def _count_phrases(tables, length: int, buckets: int, buffer: int):
    """What a task does with its texts: lists of cells and counts, and of spelled phrases, by bucket."""

    def lists(cells: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
        cut = [0, *np.searchsorted(cells, edges).tolist(), len(cells)]
        rows = [(i, cells[a:b].tobytes(), n[a:b].tobytes(), None) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
        for low in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[low : low + 256]), BLOB.types)], schema=BLOB)

    def phrases(spelled: Counter) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list] = {}
        for (lang, phrase), n in spelled.items():
            rows.setdefault(spelled_bit(lang, phrase) * buckets >> MEMBER_BITS, []).append((lang, phrase, n))
        spelled.clear()
        yield pa.RecordBatch.from_pylist([{"bucket": i, "spelled": pickle.dumps(r)} for i, r in rows.items()], BLOB)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Tables = tables.value
        ids, none = own.ids(), {bytes([b]): BREAK for b in BREAKS}
        tiles, spelled = Tiles(), Counter()
        open_: dict[str, list[bytes]] = {}

        def count() -> Iterator[pa.RecordBatch]:
            for lang, found in open_.items():
                number, words = ids.get(lang, (0, none))
                if len(found) >= length:
                    codes, places = _windows(found, lang, number, words, own, length)
                    spelled.update((lang, b" ".join(found[t : t + length])) for t in places.tolist())
                    for done in tiles.add(codes):
                        yield from lists(*done)
                    # a phrase may go on in the next slice of the same text
                    del found[: len(found) - length + 1]
            if len(spelled) > SPELLED:
                yield from phrases(spelled)

        waiting = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                some = batch.slice(low, 64)
                for lang, text in zip(some.column("lang").to_pylist(), some.column("text").to_pylist()):
                    found = open_.setdefault(lang, [])
                    for words in tokens(text or b""):
                        found += words
                        waiting += len(words)
                        if waiting >= buffer:
                            yield from count()
                            waiting = 0
                    found.append(b"\n")
        yield from count()
        for done in tiles.rest():
            yield from lists(*done)
        yield from phrases(spelled)

    return work


def _merge_phrases(tables, length: int, min_count: int):
    """Adds up the lists of one bucket after the other and spells out what is frequent."""

    def named(own: Tables, cells: np.ndarray, n: np.ndarray, spelled: Counter) -> pa.RecordBatch:
        often = n >= min_count
        codes = (cells[often] * np.uint64(UNSPREAD)).astype(np.int64)
        rows = [(k, c) for k, c in spelled.items() if c >= min_count]
        lang = [own.langs[c >> 36] for c in codes.tolist()] + [k[0] for k, _ in rows]
        phrase = [own.spell(c >> 36, c, length) for c in codes.tolist()] + [k[1] for k, _ in rows]
        bits = np.concatenate((code_bit(codes), np.array([spelled_bit(*k) for k, _ in rows], np.int64)))
        both = _rows(lang, phrase, n[often].tolist() + [c for _, c in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array(codes.tolist() + [None] * len(rows), pa.int64()), *both.columns, pa.array(bits, pa.int64())],
            ["code", "lang", "phrase", "n", "bit"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Tables = tables.value
        bucket, cells, counts, size, spelled = None, [], [], 0, Counter()

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((cells, np.uint64), (counts, np.int64)))
            order = np.argsort(keys, kind="stable")
            return sums(keys[order], n[order])

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    yield named(own, *merged(), spelled)
                    bucket, cells, counts, size, spelled = row["bucket"], [], [], 0, Counter()
                if row["cells"] is not None:
                    cells.append(np.frombuffer(row["cells"], np.uint64))
                    counts.append(np.frombuffer(row["counts"], np.int64))
                    size += len(cells[-1])
                    if size > 4 * BUFFER and len(cells) > 1:
                        one = merged()
                        cells, counts, size = [one[0]], [one[1]], 0
                else:
                    for lang, phrase, n in pickle.loads(row["spelled"]):
                        spelled[lang, phrase] += n
        yield named(own, *merged(), spelled)

    return work


def bucket_count(total: int, partitions: int) -> int:
    """How many buckets lists are cut into, of which a task sends each: one per ``BUCKET_WORDS`` words, some per partition at most."""
    return max(1, min(-(-total // BUCKET_WORDS), BUCKETS_PER_PARTITION * partitions))


def phrase_counts(
    docs: DataFrame, tables, length: int, min_count: int, text_col: str = "text", lang_col: str = "lang", buffer: int = 1 << 18
) -> DataFrame:
    """``code, lang, phrase, n, bit`` of the phrases of ``length`` words that occur ``min_count`` times.

    ``tables`` is a broadcast :class:`Tables`; a phrase beyond them has a null code.
    """
    buckets = bucket_count(tables.value.total, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    lists = _docs(docs, text_col, lang_col).mapInArrow(
        _count_phrases(tables, length, buckets, buffer), "bucket int, cells binary, counts binary, spelled binary"
    )
    return lists.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _merge_phrases(tables, length, min_count), "code bigint, lang string, phrase string, n bigint, bit bigint"
    )


def most_frequent(df: DataFrame, most: int, n: str = "n") -> DataFrame:
    """The rows of highest ``n``, at most ``most``: as many whole steps of the count as fit.

    A step is a sixteenth of a doubling, so the table of steps has some hundred rows.
    """
    step = F.floor(F.log2(F.col(n)) * 16)
    held = sorted(((r.step, r.rows) for r in df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True)
    total, least = 0, None
    for at, rows in held:
        total += rows
        if total > most:
            break
        least = at
    return df.where(step >= F.lit(least if least is not None else 1 << 20))


def _bitmap(marked: DataFrame) -> np.ndarray:
    """The bits of column ``bit``, set in the cluster; the driver gets the bitmap's words, at most a million."""
    mask = F.expr("bit_or(shiftleft(1L, cast(bit % 64 AS INT)))")
    marks = marked.groupBy(F.expr("bit div 64").alias("at")).agg(mask.alias("mask")).toArrow()
    bits = np.zeros((1 << MEMBER_BITS) // 64, np.uint64)
    at, value = (np.asarray(marks.column(c).combine_chunks().to_numpy(zero_copy_only=False), np.int64) for c in ("at", "mask"))
    bits[at] = value.view(np.uint64)
    return bits


def _word_table(words: DataFrame, most: int) -> Tables:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            yield pa.RecordBatch.from_pydict({"bit": pa.array([spelled_bit(l, p.encode()) for l, p in pairs], pa.int64())})

    rows = most_frequent(words, most).select("lang", "phrase", "n").toArrow().to_pylist()  # at most ``most``
    by_lang: dict[str, list[tuple[int, bytes]]] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append((-r["n"], r["phrase"].encode()))
    langs = sorted(by_lang)
    bits = _bitmap(words.select("lang", "phrase").mapInArrow(mark, "bit bigint"))
    return Tables(langs, [[w for _, w in sorted(by_lang[l])] for l in langs], bits)


def _level(counted: DataFrame, most: int) -> Level:
    """Ranks the most frequent phrases that have a code, and marks all frequent phrases in the bitmap."""
    top = most_frequent(counted.where("code IS NOT NULL"), most).select("code", "n").toArrow()
    code, n = (np.asarray(top.column(c).combine_chunks().to_numpy(zero_copy_only=False), np.int64) for c in ("code", "n"))
    order = np.lexsort((code, -n, code >> 36))
    code = code[order]
    lang = code >> 36
    first = np.searchsorted(lang, lang, "left") if len(lang) else lang
    rank = np.arange(len(code)) - first
    by_rank = {int(l): code[lang == l] for l in np.unique(lang)}
    sort = np.argsort(code)
    return Level(code[sort], rank[sort], _bitmap(counted), by_rank)


def frequent_phrases(
    docs: DataFrame,
    max_words: int = 3,
    min_count: int = 10,
    text_col: str = "text",
    lang_col: str = "lang",
    table: int = TABLE,
) -> DataFrame:
    """``lang, phrase, words, n`` of every phrase that occurs ``min_count`` times in its language.

    The row with a null phrase and 0 words holds the number of words of its language.
    """
    if not 0 < table <= TABLE:
        raise ValueError("ids have 18 bits")
    context = docs.sparkSession.sparkContext
    counted = word_counts(docs, text_col, lang_col).where((F.col("n") >= min_count) | F.col("phrase").isNull())
    words = materialise(counted, "collocation-words")
    size = F.when(F.col("phrase").isNull(), F.lit(0)).otherwise(F.lit(1))
    found = words.select("lang", "phrase", size.alias("words"), "n")
    tables = _word_table(words.where("phrase IS NOT NULL"), table)
    tables.total = words.where("phrase IS NULL").agg(F.sum("n")).first()[0] or 0
    for length in range(2, max_words + 1):
        sent = context.broadcast(tables)
        named = materialise(phrase_counts(docs, sent, length, min_count, text_col, lang_col), f"collocation-{length}")
        found = found.union(named.select("lang", "phrase", F.lit(length), "n"))
        if length < max_words:
            tables.levels.append(_level(named, table))
    return found


def _with_count(df: DataFrame, part: str, out: str, counts: DataFrame, top: DataFrame) -> DataFrame:
    """Adds the count of the phrase in column ``part``.

    The most frequent phrases, which are part of most others, come from a broadcast
    table; the rest by a join whose keys none but a few rows share.  Rows already
    served take a key of their own that matches nothing.
    """
    known = F.broadcast(top.select(F.col("lang").alias("_l"), F.col("phrase").alias("_p"), F.col("n").alias("_top")))
    rest = counts.select(F.col("lang").alias("_l"), F.col("phrase").alias("_p"), F.col("n").alias("_n"))
    first = df.join(known, (F.col("lang") == F.col("_l")) & (F.col(part) == F.col("_p")), "left").drop("_l", "_p")
    key = F.when(F.col("_top").isNull(), F.col(part)).otherwise(F.concat(F.lit(" "), "phrase"))
    joined = first.withColumn("_key", key).join(rest, (F.col("lang") == F.col("_l")) & (F.col("_key") == F.col("_p")), "left")
    return joined.withColumn(out, F.coalesce("_top", "_n")).drop("_l", "_p", "_n", "_top", "_key")


def exact_score(a: Column, l: Column, r: Column) -> Column:
    """floor(1,000,000 a a / (l r)) in decimals of 38 digits, enough for counts of up to 15 digits."""
    square = F.lit(1_000_000).cast("decimal(7,0)") * (a.cast("decimal(15,0)") * a.cast("decimal(15,0)"))
    return F.floor(F.call_function("div", square, l.cast("decimal(15,0)") * r.cast("decimal(15,0)"))).cast("bigint")


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    min_count: int = 10,
    top: int = 2000,
    absorb_percent: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    table: int = TABLE,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is scored at its weakest cut, and left out if a longer frequent phrase that
    holds it has at least ``absorb_percent`` of its occurrences.
    """
    found = frequent_phrases(docs, max_words, min_count, text_col, lang_col, table)
    counts = found.where("words > 0")
    phrases = found.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("parts"))
    inner = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.col("words") - 1),
                lambda size: F.transform(
                    F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice("parts", at, size), " ")
                ),
            )
        )
    )
    longer = phrases.where("words > 2").select("lang", inner.alias("inner"), "a").groupBy("lang", "inner").agg(F.max("a").alias("most"))
    alone = phrases.join(
        longer.withColumnRenamed("lang", "_l"), (F.col("lang") == F.col("_l")) & (F.col("phrase") == F.col("inner")), "left"
    ).where(F.col("most").isNull() | (100 * F.col("most") < absorb_percent * F.col("a")))
    cut = alone.select("lang", "phrase", "a", "parts", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    often = most_frequent(counts, 1 << 16)
    sized = _with_count(_with_count(cut, "first", "l", counts, often), "rest", "r", counts, often)
    scored = sized.select("lang", "phrase", "a", F.struct(exact_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"))
    weakest = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut")).select("lang", "phrase", "a", "cut.*")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    # a language is first cut to its best per part, so that no task sorts it whole
    best = weakest.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    last = best.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    totals = found.where("words = 0").select(F.col("lang").alias("_l"), F.col("n"))
    return last.where(F.col("rank") <= top).join(totals, F.col("lang") == F.col("_l")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
