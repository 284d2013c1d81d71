"""Token counts, mixing, fingerprints, near duplicates, packing and the pipeline against plain Python."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import near_components, quality, redacted, targets
from test_text_filters import DOCS, empty, texts_of, with_edges

import corpus_pipeline
from lakeops.llm import fingerprints, mixing, neardup, packing, pii, tokens
from lakeops.llm.graph import components

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_EDGES = [
    " ", "  a", "a ", "a  b   c ", "▁x ▁▁y", "日本語 ñ <s> </s> <0x0A>\n\n x", "\x00a\tb\r\nc", "it's we'll 'S\n  \n x12ab ½ ª",
    "<|endoftext|> hi<|endoftext|>", "é" * 3_000, "a" * 9_000, "x " * 20_000, "\U0001f600 \u2003wide",
]


def test_token_counts(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = with_edges(spark, TOKEN_EDGES)
    texts = texts_of(docs)
    for options in ({}, {"table_size": 3, "sample_rows": 5}):
        for r in tokens.count_tokens(docs, PIECES, **options).collect():
            text = texts[r.doc_id] or ""
            assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(model.encode(text))), r
            assert r.over_limit == (r.n_tokens > 4096)
    assert tokens.count_tokens(empty(spark), PIECES).count() == 0


def test_worker_cache_stays_bounded():
    lengths = tokens.Lengths(tokens.load_model(PIECES), {"the": 1}, limit=10)
    assert lengths.count(" ".join(f"w{i}" for i in range(100))) and len(lengths) <= 10 and lengths["the"] == 1


def test_long_pre_tokens_are_counted_but_not_kept():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    lengths = tokens.Lengths(tokens.load_model(PIECES), {})
    kept, long = "w" * tokens.LONGEST_KEPT, [c * 5_000 + "é" * n for c in "abc" for n in range(3)]
    text = " ".join([kept, *long, *long])
    assert lengths.count(text) == len(model.encode(text))
    assert set(lengths) == {kept}
    assert sum(map(len, lengths)) <= tokens.LONGEST_KEPT * len(lengths)


def check_packing(rows, ids, capacity=1024):
    """Pieces rebuild the documents; sequences are gapless and not longer than the capacity."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.piece, r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by_doc, by_sequence


def test_packing(spark):
    library = packing.Ids(BYTES).library
    docs = with_edges(spark, TOKEN_EDGES)
    ids = {k: [*library.encode(t or "", add_special_tokens=False).ids, 2] for k, t in texts_of(docs).items()}
    rows = packing.pack(docs, BYTES).collect()
    by_doc, by_sequence = check_packing(rows, ids)
    copies = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert by_doc.keys() == copies.keys()
    for k, parts in by_doc.items():
        parts = sorted(parts)[:: copies[k]]
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        assert sum(length for _, _, length in parts) == len(ids[k])
        assert all(length == 1024 for _, _, length in parts[1:])
    least = -(-sum(len(ids[k]) * n for k, n in copies.items()) // 1024)
    assert len(by_sequence) <= least * 1.02 + 1
    assert packing.pack(empty(spark), BYTES).count() == 0


def test_fast_ids_equal_the_library():
    ids = packing.Ids(BYTES)
    assert ids.fast is not None
    pick = random.Random(1)
    alphabet = " \n\t'abcdesStrvml0123.,!?-éèñßÄſ"
    for _ in range(5_000):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 40)))
        assert ids.of(text) == np.array(ids.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_fullest_finds_the_best_sum():
    pick = random.Random(2)
    for _ in range(300):
        counts = {pick.randint(1, 30): pick.randint(1, 3) for _ in range(pick.randint(1, 5))}
        room = pick.randint(1, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        chosen = packing.fullest(counts, room)
        assert sum(chosen) == max(s for s in sums if s <= room)
        assert all(n <= counts[l] for l, n in collections.Counter(chosen).items())


def test_minimum_slack_uses_everything_once():
    pick = random.Random(3)
    counts = {pick.randint(1, 1024): pick.randint(1, 50_000) for _ in range(400)}
    used = collections.Counter()
    for p in packing.minimum_slack(counts):
        assert sum(p.lengths) <= 1024
        for length in p.lengths:
            used[length] += p.repeats
    assert used == counts


def test_mix(spark):
    docs = with_edges(spark, ["a b c", "d " * 300])
    rows = mixing.mix_report(docs).collect()
    again = mixing.mix_report(docs.repartition(3)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    source = dict(docs.select("doc_id", "source").collect())
    text = texts_of(docs)
    size, taken = collections.Counter(), collections.Counter()
    for r in rows:
        assert r["size"] == len((text[r.doc_id] or "").split()) and r.taken in {k * r["size"] for k in range(4)}
        size[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
    want = targets(size)
    longest = max(r["size"] for r in rows)
    for r in rows:
        assert r.source_size == size[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
    for s in size:
        assert abs(taken[s] - want[s]) <= longest
    assert sum(taken.values()) <= sum(size.values())
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    copies = collections.Counter(r.doc_id for r in mixed.select("doc_id").collect())
    total = collections.Counter()
    for r in rows:
        total[r.doc_id] += r.taken // r["size"] if r["size"] else 0
    assert copies == +total
    assert mixing.mix_report(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


def test_targets_by_hand(spark):
    rows = [(1, "a", "w " * 10), (2, "b", "w " * 10), (3, "c", "w " * 180), (4, None, None)]
    got = {r.doc_id: r.target for r in mixing.mix_report(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    # a and b stop at 30; c has the rest; the source without a name has no words
    assert got == {1: 30.0, 2: 30.0, 3: 140.0, 4: 0.0}


FINGER_EDGES = ["a", "ab cd", "ab cd", "\U0001f600" * 9, "x" * 100_000, "a b " * 2_000]


def test_fingerprints(spark):
    docs = with_edges(spark, FINGER_EDGES).dropDuplicates(["doc_id"])
    texts = {k: t or "" for k, t in texts_of(docs).items()}
    order = sorted(texts)
    after = dict(zip(order, order[1:] + order[:1]))
    for ranges in (None, 1, 50):
        rows = fingerprints.edited_fingerprints(docs, ranges=ranges).collect()
        assert sorted(r.doc_id for r in rows) == order
        for r in rows:
            own, then = texts[r.doc_id], texts[after[r.doc_id]]
            quarter = len(own) // 4
            edited = own[: len(own) - quarter] + then[:quarter]
            prints = [fingerprints.order_minhash(t) for t in (own, edited, then)]
            assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
            assert [r.fingerprint, r.edited_fingerprint] == prints[:2]
            assert r.near_edited == fingerprints.likeness(*prints[:2])
            assert r.near_next == fingerprints.likeness(prints[0], prints[2])
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0
    assert fingerprints.fingerprints(docs).count() == docs.count()


def test_fingerprints_with_repeated_and_missing_ids(spark):
    rows = [(None, "n one"), (1, "b two"), (1, "a three"), (2, None), (1, "b two")]
    got = fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), ranges=3).collect()
    assert collections.Counter(r.doc_id for r in got) == {None: 1, 1: 3, 2: 1}
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(7, "alone here")], "doc_id long, text string")).first()
    assert one.near_next == 1.0


def test_order_matters_to_a_fingerprint():
    words = [f"word{i}" for i in range(400)]
    text = " ".join(words)
    moved = " ".join(words[200:] + words[:200])
    one_edit = text.replace("word77", "wrd77")
    same = fingerprints.likeness(fingerprints.order_minhash(text), fingerprints.order_minhash(one_edit))
    turned = fingerprints.likeness(fingerprints.order_minhash(text), fingerprints.order_minhash(moved))
    assert same > 0.9 and turned < same - 0.2


def variants(n, seed):
    """Near copies of one long text at all similarities around the limit."""
    pick = random.Random(seed)
    base = [f"w{pick.randint(0, 10**6)}" for _ in range(300)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(pick.randint(0, 12)):
            words[pick.randrange(len(words))] = f"v{pick.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


NEAR_EDGES = ["a b", "A  b", "x y z w v u", "x y z w v u", *variants(90, 4)]


def test_near_duplicates(spark):
    docs = with_edges(spark, NEAR_EDGES)
    texts = texts_of(docs)
    want = near_components(texts)
    for options in ({}, {"block": 7, "block_shingles": 3_000}):
        rows = neardup.near_duplicates(docs, **options).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, (_, c) in want.items() if k == c}
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_odd_sketch_estimate():
    sampler, words = neardup.MinHash(252), neardup.Words()
    texts = variants(60, 5)
    sets = [neardup.shingles(t, words) for t in texts]
    sketches = neardup.odd_sketches(np.array([sampler.of(s) for s in sets]))
    differing = np.bitwise_count(sketches[:, None] ^ sketches[None]).sum(axis=2)
    both = neardup.shared(sets)
    sizes = np.array([len(s) for s in sets])
    exact = both / (sizes[:, None] + sizes[None] - both)
    assert all(both[i, j] == len(set(sets[i]) & set(sets[j])) for i in range(9) for j in range(i))
    np.fill_diagonal(exact, 1.0)
    high = exact >= 0.8
    assert np.abs(neardup.estimate(differing, 252) - exact)[high].max() < neardup.MARGIN


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, k) for k in range(1, 50)] + [(3, 3), (60, 50), (50, 60)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(100, 141)} == {100} and {got[k] for k in range(50)} == {0} and got[60] == 50


def test_null_ids_in_near_duplicates(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (None, "q r s"), (9, None), (None, "")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == sorted(
        [("None", 2, "4", False), ("None", 2, "4", False), ("4", 2, "4", True), ("None", 1, "None", True),
         ("9", 0, "9", True), ("None", 0, "None", True)]
    )


def test_pipeline_stages(spark):
    """Each stage on its own input, against plain Python."""
    docs = spark.read.parquet(DOCS)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    sf_dir = DOCS.rpartition("/")[0]

    good = stages["quality_rules"](spark, docs, sf_dir)
    texts = texts_of(docs)
    assert set(texts_of(good)) == {k for k, t in texts.items() if quality(t)[-1]}

    single = stages["near_dedup"](spark, good, sf_dir)
    own = texts_of(good)
    want = near_components(own, corpus_pipeline.NEAR_PERCENT)
    assert set(texts_of(single)) == {k for k, (_, c) in want.items() if k == c}

    hidden = stages["personal_data"](spark, single, sf_dir)
    spans = {r.doc_id: r.spans for r in pii.span_report(single).collect()}
    for r in hidden.collect():
        assert r.text == redacted(own[r.doc_id], spans[r.doc_id]) and r.n_chars == len(r.text)

    mix = stages["source_mix"](spark, hidden, sf_dir)
    taken = {r.doc_id: r.taken for r in mixing.mix_report(hidden).collect()}
    copies = collections.Counter(r.doc_id for r in mix.select("doc_id").collect())
    clean = texts_of(hidden)
    assert all(taken[k] == copies[k] * len(clean[k].split()) for k in taken)
    for df in (good, single, hidden, mix):
        assert df.columns == columns

    library = packing.Ids(BYTES).library
    ids = {k: [*library.encode(clean[k], add_special_tokens=False).ids, 2] for k in copies}
    rows = stages["packing"](spark, mix, sf_dir).collect()
    check_packing(rows, ids)
    assert sum(r.length for r in rows) == sum(len(ids[k]) * n for k, n in copies.items())


def test_pipeline_runs_end_to_end(spark):
    out = corpus_pipeline.run(spark, DOCS.rpartition("/")[0])
    assert out.count() > 0 and "sequence_id" in out.columns


def test_pipeline_takes_an_empty_table(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
