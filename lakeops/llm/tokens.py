"""Token counts of whole texts by a two-tier lookup on the map side.

A sentencepiece BPE model whose pieces hold spaces only at their start never
merges across the start of a run of spaces.  The number of tokens of a text is
then the sum over its pre-tokens, each a run of spaces with the characters up to
the next.  Tier one is a broadcast table of the pre-tokens frequent in a bounded
sample; tier two a bounded cache of each worker, filled by encoding what it
misses; both keep pre-tokens of up to 64 characters only.  Nothing is shuffled.  The sample decides only how often tier one hits.

Defined results: a null text is empty and has 0 bytes and 0 tokens; repeated rows
are counted alike; an empty table gives an empty table; other columns are ignored.
A model with a piece that has a space after another character, or that
normalises its input, is refused.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 32_768
SAMPLE_ROWS = 2_000
CACHE_SIZE = 400_000
LONGEST_KEPT = 64  # characters; with it the table and each cache hold at most 64 characters an entry
MARK = "▁"  # how the model writes a space
RUN = re.compile(" +[^ ]*")


def load_model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    inside = re.compile(f"[^{MARK}]{MARK}")
    if any(inside.search(model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("a piece holds a space after another character; pre-tokens are not independent")
    probe = "Ａ ﬁ  b "
    if model.normalize(probe).replace(MARK, " ") != " " + probe:
        raise ValueError("the model normalises its input; pre-tokens are not independent")
    return model


class Lengths(dict):
    """Pre-token without its first space -> number of tokens.

    Starts as the broadcast table; misses are encoded and kept until ``limit``
    entries, when the cache starts over from the table.  A pre-token longer than
    ``LONGEST_KEPT`` characters is encoded each time and not kept.
    """

    def __init__(self, model, table: dict[str, int], limit: int = CACHE_SIZE):
        super().__init__(table)
        self.model, self.table, self.limit = model, table, limit

    def __missing__(self, key: str) -> int:
        # the model itself puts one space before a text, except before an empty one
        n = len(self.model.encode(key)) if key else 1
        if len(key) > LONGEST_KEPT:
            return n
        if len(self) >= self.limit:
            self.clear()
            self.update(self.table)
        self[key] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(MARK, " ")
        if "  " not in text and text[0] != " ":
            return sum(map(self.__getitem__, text.split(" ")))
        return sum(self[run[1:]] for run in RUN.findall(" " + text))


def frequent_lengths(
    docs: DataFrame, model_path: str, text_col: str = "text", size: int = TABLE_SIZE, sample_rows: int = SAMPLE_ROWS
) -> dict[str, int]:
    """Lengths of the ``size`` pre-tokens most frequent in at most ``sample_rows`` rows."""
    seen: Counter[str] = Counter()
    for row in docs.select(F.col(text_col).alias("text")).head(sample_rows):
        seen.update(word for word in (row.text or "").split(" ") if len(word) <= LONGEST_KEPT)
    lengths = Lengths(load_model(model_path), {}, limit=size + 1)
    # longest first among equals would waste room: order by frequency, then by the word itself
    return {word: lengths[word] for word, _ in sorted(seen.items(), key=lambda kv: (-kv[1], kv[0]))[:size]}


def count_tokens(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
    table_size: int = TABLE_SIZE,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(docs, model_path, text_col, table_size, sample_rows))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(load_model(model_path), table.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tokens = pa.array([lengths.count(t or "") for t in texts], pa.int64())
            sizes = pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens], ["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    counted = slim.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
