"""Near-duplicate verdicts by row: repeated ids, repeated rows, null ids."""

import collections

import pytest

from lakeops.llm import neardup

A, B, C = "a b c d e f g h", "q r s t u v w x", "one two three four five six"


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, A, "s")] * 3 + [(2, A, "s")], [(1, A, "s")]),
        ([(1, A, "z"), (1, A, "b"), (1, A.upper(), "b")], None),
        ([(5, A, "s"), (5, B, "s"), (3, B, "s"), (7, A, "s")], [(5, A, "s"), (3, B, "s")]),
        ([(5, A, "s"), (5, B, "s"), (9, B, "s")], [(5, A, "s"), (5, B, "s")]),
        (
            [(None, A, "s"), (None, A, "s"), (4, A, "s"), (None, C, "s"), (None, C, "s"), (9, None, "s"), (None, "", "s")],
            [(4, A, "s"), (None, C, "s"), (9, None, "s"), (None, "", "s")],
        ),
        ([(8, " ", "s"), (8, " ", "s"), (8, None, "s")], [(8, " ", "s"), (8, " ", "s"), (8, None, "s")]),
    ],
)
def test_one_row_of_each_group_stays(spark, rows, want):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = collections.Counter(map(tuple, neardup.without_near_duplicates(docs).collect()))
    if want is None:
        assert sum(kept.values()) == 1 and set(kept) <= set(rows)
        again = neardup.without_near_duplicates(docs.repartition(5, "source")).collect()
        assert collections.Counter(map(tuple, again)) == kept
    else:
        assert kept == collections.Counter(want)


def test_one_text_of_each_class_is_fetched(spark):
    texts = [f"{i} b c d e f g" for i in range(40)] * 2
    for doc_id in (None, 5):
        keyed = spark.createDataFrame([(doc_id, t, t.encode()) for t in texts], "doc_id long, text string, row binary")
        classes = keyed.distinct().selectExpr("doc_id as rep", "row as rep_row", "text as own")
        got = neardup.class_texts(keyed, classes).collect()
        assert len(got) == 40 and all(r.text == r.own for r in got)


def test_links_among_texts_of_one_null_id(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base, f"end{i}"]) for i in range(12)] * 2 + [C]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert neardup.without_near_duplicates(docs).count() == 2
