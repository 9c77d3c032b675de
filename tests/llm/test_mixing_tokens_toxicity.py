"""Mixing, token files, the classifier chain and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash

from tests.llm.conftest import ROWS, frame
from tidemark.llm import mixing, tokens, toxicity
from tidemark.llm.common import ROW_KEY, by_row, shared_folder, stored

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def shares(sizes, cap=3):
    """Targets by the stated rule: reshare what is above the cap until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest, whole = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] > cap * sizes[s] * whole]
        if not over:
            return {**fixed, **{s: rest * weight[s] / whole for s in free}}
        fixed |= {s: cap * sizes[s] for s in over}


def test_targets_and_takes(spark):
    rng = random.Random(3)
    sizes = {"a": 40, "b": 900, "c": 300, "d": 20, "é": 60, None: 120}
    rows = []
    for source, n in sizes.items():
        rows += [(len(rows) + k, " ".join(["w"] * rng.randint(1, 60)), source) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mixture(df).collect()
    whole, taken = Counter(), Counter()
    source = {r[0]: r[2] for r in rows}
    for r in got:
        whole[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size
    want = shares(whole)
    for r in got:
        assert r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == whole[source[r.doc_id]]
    for s, target in want.items():
        assert abs(taken[s] - target) <= 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixture(df).collect()))


def test_hot_length_is_ranked_in_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 50)
    rows = [(i, "one two three", "a") for i in range(900)] + [(900 + i, "x " * 9, "b") for i in range(100)]
    got = mixing.mixture(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    for r in got.groupBy("source_size", "target").agg({"taken": "sum"}).collect():
        assert abs(r["sum(taken)"] - r.target) <= 9


def test_fit_is_exact_where_brute_force_is():
    rng = np.random.default_rng(5)
    for _ in range(40):
        sizes = np.unique(rng.integers(1, 40, 6))
        counts = rng.integers(1, 4, len(sizes))
        budget = int(rng.integers(0, int((sizes * counts).sum()) + 1))
        take = mixing.fit(sizes, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        base = np.array([int(c) * budget // int((sizes * counts).sum()) for c in counts])
        sums = {0}
        for s, n in zip(sizes, counts - base, strict=True):
            sums = {x + k * int(s) for x in sums for k in range(n + 1)}
        rest = budget - int((base * sizes).sum())
        assert abs(int((take * sizes).sum()) - budget) == min(abs(x - rest) for x in sums)


def test_mix_of_odd_rows(spark, odd, none):
    got = mixing.mixture(odd).collect()
    assert len(got) == len(ROWS) and {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    n = Counter(r.doc_id for r in mixed.collect())
    assert n[1] == n[2] == n[3] == 1
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.taken
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len((r.text or "").split())
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.mixture(none).count() == 0 and mixing.mix(none).count() == 0


TEXTS = [
    "ábc É ≠ x", "it's we'Re 'Street o'clock", "<|endoftext|> hi <|ENDOFTEXT|>", "ÀÉ×÷ª º µ ÿ Ÿ ß ẞ İ ı", "  \n\t a\x1cb\x85c",
    "x1y2 3.14 foo_bar a-b,c;d 你好 мир ①②", "don't!!! (yes) \"q\"'s", "naïve.§ é,§", "é å ≮", "🙂🙂 ok",
]


def test_encoder_is_the_library():
    coder = tokens.Encoder(VOCABULARY)
    assert coder.by_word
    for text in TEXTS:
        assert coder.encode(pa.array([text]))[0].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY_WORDS", 3)
    coder = tokens.Encoder(VOCABULARY)
    for text in ["one two three, four", "five, six seven", "one two. eight"] * 2:
        assert coder.encode(pa.array([text]))[0].tolist() == coder.tokenizer.encode(text).ids


def test_token_files(spark, odd, none):
    rows = [(i * 7 % 31, t, "s") for i, t in enumerate(TEXTS)] + ROWS
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    got = sorted(map(tuple, tokens.round_trip(df, VOCABULARY, 2).collect()), key=lambda r: r[1])
    coder = tokens.Encoder(VOCABULARY).tokenizer
    seed = 42  # of the engine's xxhash64, which is also that of a null

    def turn(t):
        return np.array([seed if t is None else xxhash.xxh64_intdigest(t.encode(), seed)], np.uint64).view(np.int64)[0]

    order = sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, turn(r[1])))
    start = 0
    for (doc, text), found in zip(order, got, strict=True):
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert found == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert tokens.round_trip(none, VOCABULARY, 2).count() == 0
    manifest = tokens.write(odd, shared_folder(spark, "t"), VOCABULARY, 2, 3).collect()
    assert sum(r.n_docs for r in manifest) == len(ROWS)
    assert [r.base for r in sorted(manifest, key=lambda r: r.part)][0] == 0


def test_chain_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = toxicity.labelled(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    held = labels.where("pmod(hash(doc_id), 4) = 0")
    model = toxicity.train(docs, labels.where("pmod(hash(doc_id), 4) <> 0"))
    found = toxicity.score(docs, model).join(held.withColumnRenamed("toxic", "truth").select("doc_id", "truth"), "doc_id").collect()
    hits = sum(r.toxic and r.truth == 1 for r in found)
    assert hits >= 0.9 * sum(r.truth for r in found) and hits >= 0.95 * sum(r.toxic for r in found)


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (6, 1, None), (77, 0, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(odd, toxicity.labelled(labels))
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ROWS) and not any(r.toxic for r in got)
    assert toxicity.keep_clean(odd, labels).columns == odd.columns
    assert toxicity.keep_clean(odd, labels).count() == len(ROWS)
    assert toxicity.score(none, toxicity.train(none, toxicity.labelled(labels))).count() == 0


def test_chain_uses_earlier_categories():
    rng = np.random.default_rng(2)
    first = rng.integers(0, 2, 400).astype(float)
    x = np.arange(400), np.zeros(400, np.int64), first * 3
    labels = np.column_stack([first, first])
    models, limits = toxicity.fit_chain(x, 1, labels, np.arange(400) % 5)
    assert models[0][1].shape == (0,) and models[1][1].shape == (1,) and models[1][1][0] > 0
    assert all(0.2 <= t <= 0.8 for t in limits)


def test_stages_judge_rows_and_not_ids(spark, monkeypatch):
    import corpus_pipeline

    passage = " ".join(f"leak{i}" for i in range(20))
    text = " ".join(f"plain{i} word{i % 7}" for i in range(60))
    other = " ".join(f"quite{i} different{i % 5}" for i in range(60))
    rows = [
        (None, f"{text} {passage}", "a"), (1, f"{other} {passage}", "a"), (1, text, "a"), (2, other, "a"),
        (2, text, "a"), (None, text, "a"), (3, None, "a"), (3, "", "a"),
    ]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: bench)
    clean = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, docs, "").collect())
    assert clean == Counter((i, t) for i, t, _ in rows if passage not in (t or ""))
    one = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in one) == Counter([(1, text), (1, f"{other} {passage}"), (3, None), (3, "")])
    judge = lambda *_, **__: lambda b: pa.RecordBatch.from_arrays(
        [*b.columns, *[pa.array([0.0] * len(b))] * 2, *[pa.array(["leak" in (t or "") for t in b.column("text").to_pylist()])] * 2],
        names=[*b.schema.names, "p0", "p1", "is0", "is1"],
    )
    monkeypatch.setattr(toxicity, "train", lambda *_: ([], []))
    monkeypatch.setattr(toxicity, "_scorer", judge)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = Counter((r.doc_id, r.text) for r in toxicity.keep_clean(docs, labels).collect())
    assert kept == Counter((i, t) for i, t, _ in rows if passage not in (t or ""))


def test_rows_without_an_id_are_ranked_in_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 50)
    rows = [(None, "one two three", "a")] * 900 + [(i, "x " * 9, "b") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sizes = stored(mixing.measured(df), "sizes")
    sliced = mixing.choose(sizes, mixing.plan(sizes))
    assert 0 < sliced.where("doc_id is null and times > 0").count() <= 900 and mixing.mix(df).columns == df.columns
    assert mixing.mix(df).count() == sliced.agg({"times": "sum"}).first()[0]
    plain = Counter(tuple(r) for r in mixing.mixture(df).collect())
    monkeypatch.setattr(mixing, "BROADCAST_LENGTHS", 0)
    assert Counter(tuple(r) for r in mixing.mixture(df).collect()) == plain
    order = mixing.measured(df).where("doc_id is null").select(mixing.ROW_KEY).distinct().count()
    assert order == 900


def test_mixes_of_other_file_splits_agree(spark, tmp_path):
    """Also for rows without an id, with shared ids and of one length."""
    r = random.Random(7)
    rows = [(None if i % 3 else i % 50, " ".join(r.choices("abcdef", k=4)), "s" if i % 2 else "t", i) for i in range(260)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _order bigint")
    found = []
    for parts in (1, 2, 7):
        df.repartition(parts).write.parquet(f"{tmp_path}/{parts}")
        docs = spark.read.parquet(f"{tmp_path}/{parts}")
        found.append(Counter((x.doc_id, x.text, x.source) for x in mixing.mix(docs).collect()))
        assert mixing.mix(docs).columns == df.columns
        keyed = by_row(docs)
        assert sorted(x[0] for x in keyed.select(ROW_KEY).collect()) == list(range(260))
    assert found[0] == found[1] == found[2] and sum(found[0].values()) > 100


def test_pipeline_stages(spark, sf_dir, odd, none):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_files"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, sf_dir).columns == odd.columns
        assert stage(spark, none, sf_dir).count() == 0
    got = corpus_pipeline.run(spark, sf_dir).orderBy("start").collect()
    ends = [r.start + r.n_tokens for r in got]
    assert got[0].start == 0 and [r.start for r in got[1:]] == ends[:-1]
