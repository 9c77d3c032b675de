"""Decontamination and near duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.compare import compare
from tests.llm.conftest import BASE, LONG, NEAR, ROWS, frame
from tidemark.llm import components, decontamination, near_duplicates
from tidemark.llm.common import stored
from tidemark.llm.queries import LLM_ORACLE, LLM_QUERIES

UPPER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_all_are_registered():
    assert sorted({int(re.match(r"op(\d+)_", n)[1]) for n in LLM_QUERIES}) == list(range(1, 14))


def test_op1_matches_sql(spark, sf_dir, duck):
    ok, note = compare(LLM_QUERIES["op1_decontamination"](spark, sf_dir), LLM_ORACLE["op1_decontamination"], duck)
    assert ok, note


def expect(docs, bench, size=10):
    phrases = defaultdict(set)
    for item, text in bench:
        w = WORD.findall((text or "").translate(UPPER))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            phrases[tuple(w[i : i + size])].add(item)
    out = Counter()
    for doc, text in docs:
        w = WORD.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                own = phrases.get(tuple(w[i : i + n]))
                if own:
                    hit |= set(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc, len(w), len(hit), len(found), digest, bool(hit)] += 1
    return out


def test_decontamination_of_odd_rows(spark, odd, none):
    bench = [(1, BASE), (1, "one"), (2, "ONE!"), (3, None), (4, ""), (10, " ".join(LONG.split()[500:530])), (5, "case words AND")]
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = decontamination.contamination(odd, items(spark, bench + [(None, "second line")]))
    assert Counter(tuple(r) for r in got.select(*names).collect()) == expect([r[:2] for r in ROWS], bench)
    assert decontamination.contamination(none, items(spark, bench)).count() == 0
    assert decontamination.contamination(odd, items(spark, [])).where("contaminated").count() == 0
    clean = decontamination.clean(odd, items(spark, bench))
    assert clean.columns == odd.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(["1", "2", "3", "None", "None"] + ["8"] * 0)


def test_slices_and_one_search_agree(spark, odd):
    bench = items(spark, [(i, " ".join(LONG.split()[i * 50 : i * 50 + 14])) for i in range(20)] + [(99, BASE)])
    index = decontamination.build_index(odd)
    pick = lambda df: Counter(
        (r.doc_id, r.n, tuple(sorted(r["items"])))
        for r in df.select("doc_id", "items", decontamination.hit_words().alias("n")).collect()
    )
    assert pick(decontamination.search(index, bench)) == pick(decontamination.search(index, bench, slice_words=40))


def test_proximity_needs_the_slop(spark):
    docs = spark.createDataFrame([(1, "a b c x d e"), (2, "a b c d e"), (3, "e d c b a")], "doc_id bigint, text string")
    index = decontamination.build_index(docs)
    bench = items(spark, [(7, "a b c d e")])
    near = {r.doc_id: (r["items"], r.near_items) for r in decontamination.search(index, bench, slop=1).collect()}
    assert near == {1: ([], [7]), 2: ([7], []), 3: ([], [])}
    assert {r.doc_id for r in decontamination.search(index, bench).where("size(items) > 0").collect()} == {2}


def brute_components(docs, size, percent):
    sets = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        grams = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
        sets[d] = grams if len(w) >= size else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = defaultdict(list)
    for d in sorted(sets):
        common = Counter(e for g in sets[d] for e in inverted[g])
        for e, n in common.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for g in sets[d]:
            inverted[g].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("size,rounds,rows", [(2, 2, 1024), (5, 2, 1024), (2, 0, 1024), (5, 0, 16)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, size, rounds, rows):
    """With pivots, without (all is left to the tasks), and with buckets cut into slices."""
    monkeypatch.setattr(near_duplicates, "PIVOT_ROUNDS", rounds)
    monkeypatch.setattr(near_duplicates, "SLICE_ROWS", rows)
    rng = random.Random(size)
    words = [f"t{i}" for i in range(400)]
    docs, base = [], [rng.choice(words) for _ in range(90)]
    for i in range(220):  # a group around the threshold, copies, and short texts
        edited = [w if rng.random() > 0.05 else rng.choice(words) for w in base]
        docs.append((i * 3, " ".join(edited if i % 4 else rng.choices(words, k=rng.randint(0, 12)))))
    docs += [(1000 + i, docs[5][1]) for i in range(30)] + [(2000, ""), (2001, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(df, size, 80).collect()}
    want = brute_components(docs, size, 80)
    assert got == {d: (n, c, d == c) for d, (n, c) in want.items()}


def test_near_duplicates_of_odd_rows(spark, odd, none):
    got = near_duplicates.near_duplicates(odd).collect()
    assert len(got) == len(ROWS)
    groups = Counter((r.doc_id, r.component_id, r.kept) for r in got)
    assert groups[6, 6, True] == 1 and groups[7, 6, False] == 1 and groups[8, 6, False] == 2
    assert groups[None, 6, False] == 1 and groups[None, None, True] == 1 and groups[1, 1, True] == 1
    kept = near_duplicates.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 6, 9, None, None])
    assert near_duplicates.near_duplicates(none).count() == 0 and near_duplicates.keep_one(none).count() == 0
    assert NEAR != BASE


def test_sketch_fills_every_bin_and_estimates_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 900, dtype=np.int64)).view(np.uint64)
    b = np.concatenate([a[:800], a[:100] + np.uint64(1)])
    b.sort()
    small = a[:3]
    got = near_duplicates.sketches(np.concatenate([a, b, small]), np.cumsum([0, len(a), len(b), 3]))
    assert (got != np.uint64(2**64 - 1)).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((got[0] == got[1]).mean() - true) < 0.12


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def brute_stars(links):
    least = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for u, v in links:
            m = min(least[u], least[v])
            changed |= least[u] != m or least[v] != m
            least[u] = least[v] = m
    return {u: v for u, v in least.items() if u != v}


def test_components_of_groups_take_few_passes(spark, monkeypatch):
    """Every pass costs a task for each shuffle partition in each of its stages, however few the links are."""
    written = []
    monkeypatch.setattr(components, "stored", lambda df, name: written.append(name) or stored(df, name))
    rng = random.Random(5)
    links = [(x, x // 50 * 50 + rng.randrange(50)) for x in range(3000) for _ in range(4)]
    df = stored(spark.createDataFrame(links, "u bigint, v bigint").repartition(8), "given")
    got = {r.node: r.component for r in components.components(df).collect()}
    want = brute_stars(links)
    assert got == {x: want.get(x, x) for link in links for x in link}
    assert len(written) <= 3


@pytest.mark.parametrize("task,broadcast", [(1 << 18, 1_000_000), (8, 1_000_000), (8, 0)])
def test_stars_match_brute_force(spark, monkeypatch, task, broadcast):
    """Links shortened as a whole and by small pieces, minima broadcast and joined by a shuffle."""
    monkeypatch.setattr(components, "TASK_LINKS", task)
    monkeypatch.setattr(components, "BROADCAST_LINKS", broadcast)
    rng = random.Random(task + broadcast)
    links = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(280)]
    links += [(1000, i) for i in range(1001, 1060)] + [(i, i + 1) for i in range(2000, 2060)] + [(7, 7), (5000, 5000)] + [(2**62, -(2**62))] * 3
    df = spark.createDataFrame(links, "u bigint, v bigint").repartition(5)
    got = components.stars(df).distinct().collect()
    assert len({r.u for r in got}) == len(got)
    assert {r.u: r.v for r in got} == brute_stars(links)
    assert components.stars(df.where("u = v")).count() == 0 and components.stars(df.where("u > v and u < v")).count() == 0


def test_shortened_links_are_the_stars_of_the_components():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 400):
        u, v = rng.integers(0, 300, n), rng.integers(0, 300, n)
        a, b = components.shortened(u, v)
        assert len(set(a.tolist())) == len(a)
        assert dict(zip(a.tolist(), b.tolist(), strict=True)) == brute_stars(list(zip(u.tolist(), v.tolist(), strict=True)))


def test_words_do_not_run_over_texts():
    from tidemark.llm.common import ALNUM, Words

    w = Words(pa.array(["Ab c", None, "", "d", "é1"]), ALNUM)
    assert w.counts.tolist() == [2, 0, 0, 1, 1]
    assert w.strings(np.arange(4)).to_pylist() == ["ab", "c", "d", "é1"]
    assert len(set(w.ids().tolist())) == 4


def test_frame_helper(spark):
    assert frame(spark, [(1, "x", None)]).count() == 1
