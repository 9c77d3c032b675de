"""Document fingerprints by I-Match: hashes of mid-frequency terms in several random lexicons.

Terms whose document frequency lies in a band form the lexicon. A hash deals the lexicon to
``SUBSETS`` random subsets; a document's terms of one subset, sorted and distinct, give one
hash. An edit changes only the hashes of the subsets that hold a changed term, so the share
of equal hashes tells how alike two texts are.

Long texts would hit every subset with many terms, so subsets thin out with the length: at
scale s a subset keeps one of 2**s of its terms, and s follows the text's number of distinct
lexicon terms. A fingerprint has the hashes at its own scale and the next, so texts at
neighbouring scales can be compared. A text of which no subset holds a term has the hash of
all its distinct terms instead, in the lexicon or not, so only equal sets share it.

Everything is DataFrame expressions. Document frequencies cover all documents. The lexicon
holds at most (distinct terms per document) / ``LEAST_SHARE`` terms whatever the corpus, and
is broadcast only below ``BROADCAST_TERMS``.

Defined cases: a null text is empty; texts without lexicon terms are like each other only if
their terms are the same; rows without an id come first; rows
that share an id are ordered by their text; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ordered_chunks, stored, text_chunks

SUBSETS = 64
#: Share of all documents that a term of the lexicon is in, at least and at most.
LEAST_SHARE = 1 / 2000
MOST_SHARE = 1 / 5
#: Distinct lexicon terms of the texts at scale 1 begin at twice this number.
SCALE_TERMS = 32
BROADCAST_TERMS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def term_ids(text: Column) -> Column:
    """Ids of the distinct words of a text."""
    words = F.split(F.translate(text, _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_distinct(F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """``term`` ids whose document frequency, as a share of all documents, lies in the band."""
    total = docs.count()
    seen = docs.select(F.explode(term_ids(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return stored(seen.where(F.col("n").between(least * total, most * total)).select("term"), "lexicon")


def scale(terms: Column) -> Column:
    """Scale of a text with a number of distinct lexicon terms."""
    fit = F.floor(F.log2(F.greatest(terms, F.lit(1)) / SCALE_TERMS))
    return F.greatest(fit, F.lit(0)).cast("int")


def subset(term: Column) -> Column:
    return F.pmod(F.shiftright(term, 7), F.lit(SUBSETS)).cast("int")


def last_scale(term: Column) -> Column:
    """Largest scale at which a term is still in its subset."""
    rest = F.shiftright(term, 13)
    return F.bit_count(rest.bitwiseAND(-rest) - 1).cast("int")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once a row, also where ``use`` reads it in a loop over terms."""
    return F.transform(F.array(value), use)[0]


TEXT, CHANGED, BOTH, ROW = 0, 1, 2, 3


def tagged(text: Column, changed: Column) -> Column:
    """Terms of a text and of its edited text: structs (kind, term), once for those of both."""

    def tag(terms: Column, kind: int) -> Column:
        return F.transform(terms, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term")))

    return F.concat(
        tag(F.array_except(text, changed), TEXT), tag(F.array_except(changed, text), CHANGED), tag(F.array_intersect(text, changed), BOTH)
    )


def term_hash(terms: Column) -> Column:
    """Hash of the sorted terms of a subset; '-' without terms."""
    word = F.lpad(F.lower(F.hex(F.xxhash64(F.sort_array(terms)).bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    return F.when(F.size(terms) > 0, word).otherwise(F.lit("-"))


def set_hash(terms: Column) -> Column:
    """Hash of all distinct terms of a text."""
    return F.lpad(F.lower(F.hex(F.xxhash64(F.sort_array(terms)))), 16, "0")


def all_subsets(found: Column, other: int, at: Column) -> Column:
    """Hashes by subset number at a scale, from structs (subset, terms), without the terms of kind ``other``."""
    numbers = F.sequence(F.lit(0), F.lit(SUBSETS - 1))

    def own(terms: Column) -> Column:
        return term_hash(F.transform(F.filter(terms, lambda t: (t.kind != other) & (t.last >= at)), lambda t: t.term))

    return once(F.map_from_entries(found), lambda m: F.transform(numbers, lambda j: F.coalesce(own(m[j]), F.lit("-"))))


def fingerprint(at: Column, own: Column, next_: Column, whole: Column) -> Column:
    """Text of a fingerprint; ``whole``, the hash of all terms, where no subset has one."""
    subsets = F.concat(at.cast("string"), F.lit(":"), F.array_join(own, ""), F.lit(":"), F.array_join(next_, ""))
    return F.when(F.exists(own, lambda h: h != "-"), subsets).otherwise(F.concat(F.lit("="), whole))


def likeness(a: str, b: str) -> Column:
    """Share of equal hashes among the subsets that either text has; structs (at, own, next, print)."""
    x, y = F.col(a), F.col(b)
    left = F.when(x.at >= y.at, x.own).otherwise(x.next)
    right = F.when(y.at >= x.at, y.own).otherwise(y.next)
    pairs = F.arrays_zip(left.alias("l"), right.alias("r"))
    any_ = F.filter(pairs, lambda p: (p.l != "-") | (p.r != "-"))
    same = F.size(F.filter(any_, lambda p: p.l == p.r))
    close = (F.abs(x.at - y.at) <= 1) & (F.size(any_) > 0)
    return F.when(x.print == y.print, 1.0).when(close, same / F.size(any_)).otherwise(0.0)


def with_next(docs: DataFrame) -> DataFrame:
    """``chunk``, ``row``, doc_id, text and ``other``, the text of the next document in ascending order.

    Rows are dealt to ordered chunks; the first row of the next chunk is added to each, so
    that no window spans more than a chunk.
    """
    first = F.lit(-(2**63))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("ord", F.coalesce("doc_id", first))
    chunk = ordered_chunks(rows.select("ord"), "ord", text_chunks(docs.sparkSession))
    rows = rows.withColumns({"chunk": chunk, "hash": F.xxhash64("text")})
    starts = rows.groupBy("chunk").agg(F.min("ord").alias("ord"))  # at most one row a chunk
    order = Window.partitionBy(F.lit(0)).orderBy("chunk")
    before = F.coalesce(F.lag("chunk").over(order), F.max("chunk").over(Window.partitionBy(F.lit(0))))
    starts = F.broadcast(starts.select("ord", before.alias("into")))
    heads = rows.join(starts, "ord").groupBy("into").agg(F.min(F.struct("ord", "hash", "text")).alias("h"))
    heads = heads.select(F.lit(None).cast("bigint").alias("doc_id"), "h.text", "h.ord", F.col("into").alias("chunk"), "h.hash", F.lit(1).alias("tail"))
    both = rows.withColumn("tail", F.lit(0)).unionByName(heads)
    along = Window.partitionBy("chunk").orderBy("tail", "ord", "hash")
    both = both.select("chunk", F.row_number().over(along).alias("row"), "doc_id", "text", F.lead("text").over(along).alias("other"), "tail")
    return both.where("tail = 0").drop("tail")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last quarter replaced by as many characters of ``other``."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(other, F.lit(1), quarter))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each document and of its edited text, and likeness to that and to the next document."""
    terms = lexicon(docs)
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    rows = with_next(docs).withColumn("changed", edited(F.col("text"), F.col("other")))
    rows = rows.select(
        "chunk", "row", "doc_id", F.length("text").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"),
        term_ids(F.col("text")).alias("t0"), term_ids(F.col("changed")).alias("t1"),
    )
    info = F.struct("doc_id", "n_chars", "edited_sha256", set_hash(F.col("t0")).alias("whole0"), set_hash(F.col("t1")).alias("whole1"))
    base = F.struct(F.lit(ROW).alias("kind"), F.xxhash64("chunk", "row").alias("term"))
    rows = rows.select("chunk", "row", info.alias("info"), F.explode(F.concat(F.array(base), tagged(F.col("t0"), F.col("t1")))).alias("m"))
    rows = rows.select("chunk", "row", F.when(F.col("m.kind") == ROW, F.col("info")).alias("info"), "m.*")
    rows = rows.join(terms.withColumn("known", F.lit(True)), "term", "left").where(f"known or kind = {ROW}")
    # terms of one subset, then subsets of one document: both stay in the task of their chunk
    term = F.col("term")
    one = F.when(F.col("kind") != ROW, F.struct("kind", last_scale(term).alias("last"), "term"))
    number = F.when(F.col("kind") != ROW, subset(term)).otherwise(SUBSETS)  # the row itself is beyond the subsets
    rows = rows.groupBy("chunk", "row", number.alias("subset")).agg(
        F.first("info", ignorenulls=True).alias("info"),
        F.collect_list(one).alias("terms"),
        *[F.count_if(~F.col("kind").isin(other, ROW)).alias(f"n{k}") for k, other in ((0, CHANGED), (1, TEXT))],
    )
    rows = rows.groupBy("chunk", "row").agg(
        F.first("info", ignorenulls=True).alias("info"),
        F.collect_list(F.struct("subset", "terms")).alias("subsets"),
        *[scale(F.sum(f"n{k}")).alias(f"at{k}") for k in (0, 1)],
    )
    rows = rows.select("chunk", "row", "info.*", "at0", "at1", *[
        all_subsets(F.col("subsets"), other, F.col(f"at{k}") + step).alias(f"{h}{k}")
        for k, other in ((0, CHANGED), (1, TEXT)) for h, step in (("own", 0), ("next", 1))
    ])
    for k in (0, 1):
        at, own, next_ = F.col(f"at{k}"), F.col(f"own{k}"), F.col(f"next{k}")
        text = fingerprint(at, own, next_, F.col(f"whole{k}"))
        rows = rows.withColumn(f"f{k}", F.struct(at.alias("at"), own.alias("own"), next_.alias("next"), text.alias("print")))
    rows = stored(rows.select("chunk", "row", "doc_id", "n_chars", "edited_sha256", "f0", "f1"), "fingerprints")
    order = Window.partitionBy(F.lit(0)).orderBy("chunk")
    heads = rows.where("row = 1").select("chunk", "f0")
    before = F.coalesce(F.lag("chunk").over(order), F.max("chunk").over(Window.partitionBy(F.lit(0))))
    heads = heads.select(before.alias("chunk"), F.lit(2**31 - 1).alias("row"), F.col("f0"))
    both = rows.unionByName(heads, allowMissingColumns=True)
    both = both.withColumn("f2", F.lead("f0").over(Window.partitionBy("chunk").orderBy("row"))).where("f1 is not null")
    return both.select(
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        "edited_sha256",
        F.col("f0.print").alias("fingerprint"),
        F.col("f1.print").alias("edited_fingerprint"),
        likeness("f0", "f1").alias("near_edited"),
        likeness("f0", "f2").alias("near_next"),
    )
