"""SimHash groups, whitening and ranked search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.compare import compare
from tests.llm.conftest import BASE, LONG, ROWS, frame
from tidemark.llm import ranked, simhash, whitening
from tidemark.llm.queries import LLM_ORACLE, LLM_QUERIES

UPPER = {i: i + 32 for i in range(65, 91)}


# ---- SimHash -------------------------------------------------------------------------


def mark_of(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(marks, most=4):
    """Smallest id reachable, by brute force over all pairs."""
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i][1] ^ marks[j][1]).bit_count() <= most:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(marks):
        if doc is not None:
            least[find(i)].append(doc)
    return Counter((d, f"{m:016x}", min(least[find(i)], default=None)) for i, (d, m) in enumerate(marks))


def found_groups(docs):
    return Counter(tuple(r) for r in simhash.near_duplicates(docs).collect())


def test_simhash_of_odd_rows(spark, odd, none):
    assert found_groups(odd) == groups([(i, mark_of(t)) for i, t, _ in ROWS])
    assert simhash.near_duplicates(none).count() == 0


def test_hash_is_the_engines(spark):
    texts = ["a b c d", "grüße an alle welt", "x" * 100]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h")).collect()
    assert [r.h & (2**64 - 1) for r in rows] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


def test_pieces_of_a_long_text(monkeypatch):
    text = LONG[:40_000] + "  \n" + "z" * 3000 + "\tlast words here"
    whole = simhash.fingerprint(text.encode(), 4)
    for piece in (1, 50, 1000):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert simhash.fingerprint(text.encode(), 4) == whole == np.array([mark_of(text)], np.uint64).view(np.int64)[0]
        for short in ("", " ", "one", "one two three", "a b c d", "a b c d e"):
            assert simhash.fingerprint(short.encode(), 4) & (2**64 - 1) == mark_of(short)


def cloud(seed, n, centres, flips, bits):
    """Fingerprints around some centres, a few of them far from all."""
    r = random.Random(seed)
    middle = [r.getrandbits(64) for _ in range(centres)]
    out = {r.getrandbits(64) for _ in range(50)}
    while len(out) < n:
        x = r.choice(middle)
        for b in r.sample(bits, r.randint(0, flips)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("members,bits", [(simhash.MOST_MEMBERS, range(64)), (50, range(2, 64, 5))])
def test_links_connect_as_all_pairs_do(spark, members, bits):
    """Also where buckets above a limit are cut again."""
    marks = cloud(members, 900 if members > 50 else 300, 6 if members > 50 else 1, 9, bits)
    rows = spark.createDataFrame([(m - 2**64 if m >> 63 else m,) for m in marks], "mark bigint")
    got = [(r.u & (2**64 - 1), r.v & (2**64 - 1)) for r in simhash.links(rows, 4, members).collect()]
    assert all((u ^ v).bit_count() <= 4 for u, v in got)
    number = {m: i for i, m in enumerate(marks)}
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in got:
        root[find(number[u])] = find(number[v])
    want = groups([(i, m) for i, m in enumerate(marks)])
    least = {}
    for i in range(len(marks)):
        least.setdefault(find(i), i)
    assert Counter((i, f"{m:016x}", least[find(i)]) for i, m in enumerate(marks)) == want


def test_a_bucket_yields_no_pairs():
    """A thousand fingerprints within four bits of each other give a thousand links."""
    r = random.Random(5)
    marks = np.unique(np.array([sum(1 << b for b in r.sample(range(64), 2)) for _ in range(3000)], np.uint64))
    u, v = simhash.bucket_links(np.zeros(len(marks), np.int64), marks, 4)
    assert len(u) == len(marks) - 1


def test_masks_find_every_close_pair():
    r = random.Random(3)
    for many in (1, 10**6, 10**9, 10**12):
        keys = simhash.first_masks(many, 4)
        for _ in range(300):
            off = sum(1 << b for b in r.sample(range(64), 4))
            assert any(not off & k for k in keys)
            assert any(not off & f for k in keys[:3] if not off & k for f in simhash.finer_masks(k, 4)) or all(off & k for k in keys[:3])


def test_a_third_of_the_rows_are_copies(spark):
    rows = [(i, BASE if i % 3 == 0 else f"unlike text {i} " * 20, "a") for i in range(900)]
    got = simhash.near_duplicates(frame(spark, rows)).where("component_id = 0").count()
    assert got >= 300


# ---- whitening -----------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, w double, n int, component string"


def vectors(spark, rows, parts=3):
    data = [(i, v, 1.0, 7, "x") for i, v in rows]
    return spark.createDataFrame(data, VECTORS).repartition(parts)


def plain_whitening(rows, most=8):
    keep = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in keep)
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in list(v) + [0.0] * (width - len(v))] for _, v in keep], object)
    n, s = len(x), x.sum(axis=0)
    z = np.array(n * x - s, float) / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)
    deviation = [int(((n * row - s) ** 2).sum()) for row in x]
    return [i for i, _ in keep], n, deviation, z, values[order][:most], axes[:, order][:, :most]


def test_whitening_equals_an_eigen_decomposition(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(300, 12)) @ r.normal(size=(12, 12)) * np.linspace(3, 0.01, 12)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base.astype(np.float32))]
    rows += [(300, None), (301, [1.0, None]), (302, [math.nan] * 12), (303, [math.inf] * 12), (None, rows[0][1]), (0, rows[0][1]), (304, [1.0]), (305, [])]
    ids, n, deviation, z, values, axes = plain_whitening(rows)
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert Counter(x.vec_id for x in got) == Counter(i for i in ids for _ in range(8))
    assert {x.n for x in got} == {n} and max(x.identity_error for x in got) < 1e-9
    assert Counter((x.vec_id, x.deviation) for x in got if x.component == 1) == Counter(zip(ids, deviation, strict=True))
    want = {(i, k): (z[row] @ axes[:, k] / np.sqrt(values[k])) for row, i in enumerate(ids) for k in range(8)}
    signs = {k: {round(x.whitened / want[x.vec_id, k]) for x in got if x.component == k + 1 and abs(want[x.vec_id, k]) > 1e-3} for k in range(8)}
    assert all(s in ({1}, {-1}) for s in signs.values())
    assert all(abs(abs(x.whitened) - abs(want[x.vec_id, x.component - 1])) < 1e-8 for x in got)
    share = {x.component: x.explained for x in got}
    trace = (z * z).sum() / n
    assert all(abs(share[k + 1] / (values[k] / trace) - 1) < 1e-9 for k in range(8))


def test_whitening_of_few_dimensions_and_nothing(spark):
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    assert {x.component for x in whitening.whiten(vectors(spark, flat)).collect()} == {1}
    for rows in ([], [(1, None)], [(1, [])], [(1, [3.0, 4.0]), (2, [3.0, 4.0])]):
        out = whitening.whiten(vectors(spark, rows))
        assert out.count() == 0 and out.columns[:3] == ["vec_id", "component", "n"]
    large = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])]
    out = whitening.whiten(vectors(spark, large)).collect()
    assert len(out) == 3 and {x.component for x in out} == {1} and all(x.deviation is None or x.deviation >= 0 for x in out)


def test_jacobi_and_cholesky():
    r = np.random.default_rng(1)
    for n, rank in ((1, 1), (5, 5), (8, 3), (33, 33)):
        b = r.normal(size=(rank, n)) * np.logspace(0, -5, n)
        a = b.T @ b
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape[1] <= n and np.allclose(factor @ factor.T, a, atol=1e-12)
        values, axes = whitening.one_sided_jacobi(factor)
        assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-12) and (np.diff(values) <= 0).all()
        assert np.allclose((axes * values) @ axes.T, a, atol=1e-12)
    pairs = [tuple(p) for turn in whitening._rounds(7) for p in turn]
    assert sorted(pairs) == [(i, j) for i in range(7) for j in range(i + 1, 7)]


# ---- ranked search -------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def rank_all(docs, items, top=10):
    words = [TERM.findall((t or "").translate(UPPER)) for _, t in docs]
    n_docs, total = sum(map(bool, words)), sum(map(len, words))
    tf = [Counter(w) for w in words]
    df = Counter(t for c in tf for t in c)
    out = Counter()
    for item, text in items:
        terms = TERM.findall((text or "").translate(UPPER)) if item is not None else []
        scored = []
        for (doc, _), own, count in zip(docs, words, tf, strict=True):
            if own:
                m = 25 + (75 * len(own) * n_docs) // total
                weigh = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score = sum(weigh(t) * ((10**9 * count[t]) // (1000 * count[t] + 8 * m)) for t in terms)
                if score > 0:
                    scored.append((-score, doc is None, doc or 0))
        for r, (score, missing, doc) in enumerate(sorted(scored)[:top], 1):
            out[item, r, None if missing else doc, -score] += 1
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "k") for i, t in rows], "item_id bigint, text string, score int, rank int, key string")


def found_ranks(out):
    return Counter(tuple(r) for r in out.select("item_id", "rank", "doc_id", "score").collect())


def test_op13_matches_sql(spark, sf_dir, duck):
    ok, note = compare(LLM_QUERIES["op13_ranked_search"](spark, sf_dir), LLM_ORACLE["op13_ranked_search"], duck)
    assert ok, note


def test_ranks_of_odd_rows(spark, odd, none):
    items = [(1, BASE), (2, "one ONE mixed case words and"), (3, None), (4, ""), (5, "?!"), (6, "nowhere found"), (7, LONG[:5000]), (None, "one")]
    assert found_ranks(ranked.ranked(odd, items_of(spark, items))) == rank_all([r[:2] for r in ROWS], [x for x in items if x[0] is not None])
    assert ranked.ranked(none, items_of(spark, items)).count() == 0
    assert ranked.ranked(odd, items_of(spark, [])).count() == 0


@pytest.mark.parametrize("few", [True, False])
def test_ranks_with_ties_hot_words_and_slices(spark, monkeypatch, few):
    r = random.Random(11)
    names = [f"word{i}" for i in range(400)]
    docs = []
    for i in range(700):
        text = " ".join(r.choices(names, weights=[1 / (k + 1) for k in range(400)], k=r.choice([3, 30, 300])))
        docs.append((i % 650 if i % 10 else None, text if i % 7 else docs[-1][1] if docs else text))
    items = [(k, " ".join(r.choices(names, k=20))) for k in range(30)]
    if not few:
        monkeypatch.setattr(ranked, "BROADCAST_KEYS", 0)
    rows = frame(spark, [(i, t, "a") for i, t in docs]).repartition(6)
    index = ranked.build_index(rows)
    got = ranked.search(rows, index, items_of(spark, items), probes=10, slice_terms=200_000 if few else 150)
    assert found_ranks(got) == rank_all(docs, items)


def test_bounds_are_never_below_the_score():
    r = random.Random(2)
    names = [f"t{i}" for i in range(60)]
    docs = [" ".join(r.choices(names, weights=[40 / (k + 1) for k in range(60)], k=r.randint(1, 400))) for _ in range(200)]
    keyed = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(docs)], names=["key", "text"])
    queries = ranked.Queries([(k, " ".join(r.choices(names, k=12))) for k in range(9)])
    counts = Counter(t for d in docs for t in set(d.split()))
    lookup = {int(ranked.term_counts(pa.array([t]))[1][0]): counts[t] for t in names}
    queries.weigh(200, sum(len(d.split()) for d in docs), {i: lookup.get(int(x), 0) for i, x in enumerate(queries.ids)})
    seen, bounds = 0, ranked._Bounds(queries)
    for batch in ranked._indexer([keyed]):
        for block in ranked._blocks_of([batch]):
            keys, value = bounds.of(block)
            for j, key in enumerate(keys):
                count = Counter(docs[key].split())
                m = int(queries.m(np.array([sum(count.values())]))[0])
                by_id = {int(ranked.term_counts(pa.array([t]))[1][0]): c for t, c in count.items()}
                for q in range(9):
                    tf = [by_id.get(int(queries.ids[t]), 0) for t in queries.terms[q]]
                    exact = sum(int(f) * ranked.share(c, m) for f, c in zip(queries.factors[q], tf, strict=True))
                    assert exact <= value[q, j] <= 2.2 * exact + 10**7
                seen += 1
    assert seen == 200
