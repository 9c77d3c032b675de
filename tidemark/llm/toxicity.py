"""Toxicity by a classifier chain of linear models over word and word-beginning features.

The categories are label columns in a fixed order. Each category has a logistic model over
the text's features and the probabilities of the categories before it. A later model is
trained with out-of-fold probabilities of the earlier ones, as it will meet them on new
texts; scoring runs the chain in order. Features are whole words and their first 4 to 8
bytes (a language may mark a word's tone in its stem), counted on a log scale.

The models are fitted on at most ``TRAIN_ROWS`` labelled documents, taken by a hash of their
id: features are counted and chosen by a distributed aggregation, then one task fits the
weights from the few chosen features of each. All documents are scored where they lie, in
batches; the fitted model is a few thousand numbers.

Defined cases: a null or empty text has no features and gets the base rates; labels that
are null or belong to no document are not used; a document with several labels has the
largest; without labelled documents, or with one class only, a category's probability is
its constant smoothed rate; other columns are kept by ``keep_clean`` and not read otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import ALNUM, Words, by_block, in_arrow, lists, mix, stored

TRAIN_ROWS = 6_000
CHAIN = ("low_quality", "toxic")
FOLDS = 5
PREFIXES = (4, 5, 6, 7, 8)
#: Features whose share differs between the classes by so many standard errors are used, at most so many.
LEAST_Z = 5.0
MOST_FEATURES = 3000
L2 = 2.0
STEPS = 200

_PREFIX_SEED = np.arange(16, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)


class Features:
    """Feature ids of the words of some texts: one row of ids per kind, and the text of each word."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, ALNUM)
        self.n, self.doc, length = len(words.counts), words.doc, words.end - words.start
        self.kinds = [(self.doc, words.ids())]
        for k in PREFIXES:
            long = np.flatnonzero(length > k)
            start = words.start[long]
            self.kinds.append((self.doc[long], mix(words.ids(start, start + k) ^ _PREFIX_SEED[k])))

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature id, count) for all features."""
        docs = np.concatenate([d for d, _ in self.kinds])
        ids = np.concatenate([i for _, i in self.kinds])
        order = np.lexsort((ids, docs))
        docs, ids = docs[order], ids[order]
        new = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (ids[1:] != ids[:-1])])) if len(ids) else order
        return docs[new], ids[new], np.diff(np.append(new, len(ids)))

    def of(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, column, value) of the features in ``known`` (ascending ids)."""
        docs, columns = [], []
        for doc, ids in self.kinds:
            if not len(known) or not len(ids):
                continue
            at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
            hit = known[at] == ids
            docs.append(doc[hit])
            columns.append(at[hit])
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        pair, n = np.unique(np.concatenate(docs) * len(known) + np.concatenate(columns), return_counts=True)
        return pair // len(known), pair % len(known), np.log2(1.0 + n)


def _tally(categories: int):
    """Per block of labelled texts and feature: in how many texts it is, and in how many of each category."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        docs, ids, _ = Features(block.column("text")).counts()
        kinds, code = np.unique(ids, return_inverse=True)
        ys = [block.column(f"y{k}").to_numpy().astype(float) for k in range(categories)]
        sums = [np.bincount(code, minlength=len(kinds))]
        sums += [np.bincount(code, weights=y[docs], minlength=len(kinds)) for y in ys]
        names = ["id", "n", *[f"n{k}" for k in range(categories)]]
        columns = [kinds.view(np.int64), *[s.astype(np.int64) for s in sums]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return work


def select(rows: DataFrame, categories: int) -> list[int]:
    """Ids of the features whose share differs most between the classes of any category, ascending."""
    schema = "id bigint, n bigint, " + ", ".join(f"n{k} bigint" for k in range(categories))
    sums = in_arrow(rows, by_block(_tally(categories)), schema).groupBy("id")
    sums = sums.agg(*[F.sum(c).alias(c) for c in ["n", *[f"n{k}" for k in range(categories)]]])
    every = [F.count("*").alias("n"), *[F.sum(f"y{k}").alias(f"y{k}") for k in range(categories)]]
    whole = rows.agg(*every).first()
    best = F.lit(0.0)
    for k in range(categories):
        n1 = whole[f"y{k}"] or 0
        n0 = whole.n - n1
        if n1 and n0:
            share = (F.col("n") + 1) / (whole.n + 2)
            off = F.abs(F.col(f"n{k}") / n1 - (F.col("n") - F.col(f"n{k}")) / n0)
            best = F.greatest(best, off / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0)))
    found = sums.select("id", best.alias("z")).where(F.col("z") >= LEAST_Z)
    return [r.id for r in found.orderBy(F.desc("z"), "id").limit(MOST_FEATURES).collect()]


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _dot(x, w: np.ndarray, n: int) -> np.ndarray:
    docs, columns, values = x
    return np.bincount(docs, weights=values * w[columns], minlength=n)


def fit_linear(x, extra: np.ndarray, y: np.ndarray, rows: np.ndarray, columns: int):
    """Weights, weights of the ``extra`` columns and intercept of a logistic model over the given rows.

    Gradient descent with momentum, each column scaled by its own second moment.
    """
    n, inside = len(y), np.zeros(len(y))
    inside[rows] = 1.0
    total = inside.sum()
    rate = (y[rows].sum() + 1) / (total + 2)
    w, e, b = np.zeros(columns), np.zeros(extra.shape[1]), float(np.log(rate / (1 - rate)))
    if not len(rows) or y[rows].min() == y[rows].max():
        return w, e, b
    docs, cols, values = x
    curve = np.bincount(cols, weights=values**2 * inside[docs], minlength=columns) / 4 + L2
    curve_e = (extra**2 * inside[:, None]).sum(axis=0) / 4 + L2
    pace = 1.0 / (1.0 + np.bincount(docs, minlength=n)[rows].mean())  # columns of one row move together
    vw, ve, vb = np.zeros_like(w), np.zeros_like(e), 0.0
    for step in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(_dot(x, w, n) + extra @ e + b, -30, 30)))
        g = (p - y) * inside
        vw = 0.9 * vw - pace * (np.bincount(cols, weights=values * g[docs], minlength=columns) + L2 * w) / curve
        ve = 0.9 * ve - 0.3 * ((extra * g[:, None]).sum(axis=0) + L2 * e) / curve_e
        vb = 0.9 * vb - pace * g.sum() * 4 / total
        w, e, b = w + vw, e + ve, b + vb
    return w, e, b


def fit_chain(x, columns: int, labels: np.ndarray, fold: np.ndarray):
    """The chain's models over all rows, and a threshold for each category.

    A threshold is the out-of-fold probability with the best balanced precision and recall.
    """
    n, models, extra, limits = len(labels), [], np.zeros((len(labels), 0)), []
    for y in labels.T:
        out = np.zeros(n)
        for k in range(FOLDS):
            inner, outer = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            w, e, b = fit_linear(x, extra, y, inner, columns)
            out[outer] = (_dot(x, w, n) + extra @ e + b)[outer]
        out = 1 / (1 + np.exp(-out))
        models.append(fit_linear(x, extra, y, np.arange(n), columns))
        limits.append(_threshold(out, y))
        extra = np.column_stack([extra, _logit(out)])
    return models, limits


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    if not y.any() or y.all():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits, asked = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    best = int(np.argmax(2 * hits / (asked + y.sum())))
    low = p[order[best + 1]] if best + 1 < len(p) else 0.0
    return float(np.clip((p[order[best]] + low) / 2, 0.2, 0.8))


MODEL = "category int, weights array<double>, chain array<double>, intercept double, threshold double"


def _encode(known: np.ndarray):
    """A labelled text as the columns and values of its known features."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        docs, columns, values = Features(block.column("text")).of(known)
        cut = np.searchsorted(docs, np.arange(len(block) + 1))
        names = [name for name in block.schema.names if name != "text"]
        arrays = [block.column(name) for name in names]
        arrays += [lists(columns, cut, pa.int64()), lists(values, cut, pa.float64())]
        return pa.RecordBatch.from_arrays(arrays, names=[*names, "columns", "values"])

    return work


def _fit(columns: int, categories: int):
    def run(batches):
        kept = [b for b in batches if len(b)]
        if kept:
            rows = pa.Table.from_batches(kept).combine_chunks()
            labels = np.column_stack([rows.column(f"y{k}").to_numpy() for k in range(categories)]).astype(float)
            many = pc.list_value_length(rows.column("columns")).to_numpy()
            flat = lambda c: rows.column(c).combine_chunks().flatten().to_numpy()
            x = np.repeat(np.arange(len(labels)), many), flat("columns"), flat("values")
            models, limits = fit_chain(x, columns, labels, rows.column("fold").to_numpy())
        else:
            limits = [0.5] * categories
            models = [(np.zeros(columns), np.zeros(k), -3.0) for k in range(categories)]
        out = [
            {"category": k, "weights": w.tolist(), "chain": e.tolist(), "intercept": float(b), "threshold": t}
            for k, ((w, e, b), t) in enumerate(zip(models, limits, strict=True))
        ]
        kinds = [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_pylist(out, pa.schema(list(zip(out[0], kinds, strict=True))))

    return run


def train(docs: DataFrame, labels: DataFrame, chain=CHAIN, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, list]:
    """Feature ids and one model row for each category; ``labels`` has doc_id and a 0/1 column for each."""
    k = len(chain)
    known = labels.select("doc_id", *[F.col(c).cast("int").alias(f"y{i}") for i, c in enumerate(chain)]).dropna()
    known = known.groupBy("doc_id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(k)])
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = docs.select("doc_id", "text").join(picked, "doc_id").withColumn("fold", F.pmod(F.hash("doc_id"), F.lit(FOLDS)))
    rows = stored(rows, "toxicity-sample")
    ids = np.sort(np.array(select(rows, k), np.int64).view(np.uint64))
    schema = "doc_id bigint, " + "".join(f"y{i} int, " for i in range(k)) + "fold int, columns array<bigint>, values array<double>"
    coded = rows.select(F.col("doc_id").cast("bigint"), *[f"y{i}" for i in range(k)], "fold", "text")
    coded = in_arrow(coded, by_block(_encode(ids)), schema)
    coded = coded.orderBy("doc_id", "columns").limit(train_rows).repartition(1).sortWithinPartitions("doc_id", "columns")
    return ids, coded.mapInArrow(_fit(len(ids), k), MODEL).orderBy("category").collect()


def _scorer(ids, model, limits, without=("text",)):
    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        features = Features(block.column("text"))
        n, extra, out = features.n, np.zeros((len(block), 0)), []
        for row in model:
            if not out:
                x = features.of(ids)
            z = _dot(x, row["weights"], n) + extra @ row["chain"] + row["intercept"]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            out.append(p)
            extra = np.column_stack([extra, _logit(p)])
        names = [name for name in block.schema.names if name not in without]
        arrays = [block.column(name) for name in names]
        arrays += [pa.array(p) for p in out] + [pa.array(p >= t) for p, t in zip(out, limits, strict=True)]
        names += [f"p{k}" for k in range(len(out))] + [f"is{k}" for k in range(len(out))]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return work


def score(docs: DataFrame, trained: tuple[np.ndarray, list], chain=CHAIN) -> DataFrame:
    """doc_id, ``p_<category>`` and ``<category>`` (the verdict) of each document."""
    ids, model = trained
    plain = [{"weights": np.array(r.weights), "chain": np.array(r.chain), "intercept": r.intercept} for r in model]
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    k = range(len(chain))
    schema = "doc_id bigint, " + ", ".join([f"p{i} double" for i in k] + [f"is{i} boolean" for i in k])
    rows = in_arrow(rows, by_block(_scorer(ids, plain, [r.threshold for r in model])), schema)
    return rows.select(
        "doc_id",
        *[F.col(f"p{i}").alias(f"p_{c}") for i, c in enumerate(chain)],
        *[F.col(f"is{i}").alias(c) for i, c in enumerate(chain)],
    )


def labelled(labels: DataFrame) -> DataFrame:
    """The sample labels as categories: doc_id, low_quality, toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows found toxic, whatever their ids."""
    ids, model = train(docs, labelled(labels))
    plain = [{"weights": np.array(r.weights), "chain": np.array(r.chain), "intercept": r.intercept} for r in model]
    schema = StructType(list(docs.schema.fields))
    for kind, name in (("double", "p"), ("boolean", "is")):
        for i in range(len(CHAIN)):
            schema = schema.add(f"{name}{i}", kind)
    rows = in_arrow(docs, by_block(_scorer(ids, plain, [r.threshold for r in model], without=())), schema)
    return rows.where(~F.col(f"is{CHAIN.index('toxic')}")).select(*docs.columns)
