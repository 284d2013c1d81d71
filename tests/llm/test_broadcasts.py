"""What grows with the corpus is not broadcast, however small Spark's estimate of it."""

import collections
import re

from lakeops.llm import graph, mixing, neardup


def joins(df):
    """Kind and key names of the plan's joins."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    found = re.findall(r"(BroadcastHashJoin|ShuffledHashJoin|SortMergeJoin) \[([^\]]*)\]", plan)
    return [(kind, tuple(re.sub(r"#\d+L?", "", keys).split(", "))) for kind, keys in found]


def watch(monkeypatch, module):
    seen, write = [], module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, name="stage": (seen.append((name, joins(df))), write(df, name))[1])
    return seen


def test_exploded_bands_are_not_broadcast(spark, monkeypatch):
    seen = watch(monkeypatch, graph)
    texts = [" ".join(f"w{i}x{j % 40}" for j in range(60)) for i in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts[:12])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = neardup.without_near_duplicates(docs, percent=80)
    assert [j for name, found in seen if name == "near-families" for j in found if j[1] == ("key",)] == [("SortMergeJoin", ("key",))]
    assert sorted(r.doc_id for r in kept.collect()) == list(range(30))


def test_entries_and_cells_are_not_broadcast(spark, monkeypatch):
    seen = watch(monkeypatch, mixing)
    rows = [(i, f"s{i % 3}", f"w{i} " * (1 + i % 5)) for i in range(300)]
    mix = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    assert ("SortMergeJoin", ("cell",)) in dict(seen)["mix-queue"]
    assert joins(mix) == [("SortMergeJoin", ("key", "part"))]
    got = collections.Counter((r.doc_id, r.source, r.text) for r in mix.collect())
    assert set(got) <= set(rows) and max(got.values()) <= mixing.MOST
    taken, held = (sum(len(t.split()) * n for (_, _, t), n in c.items()) for c in (got, collections.Counter(rows)))
    assert held - 5 < taken <= held
