"""Ranked lexical search over impact vectors in buckets of like length.

A document is a sparse vector of impacts: for each term of the queries, its weight times
its saturated frequency.  Vectors are put in order of their length (Euclidean norm) and
cut into buckets.  For a query with the score of its k-th best document so far as
threshold:

* a bucket goes when the query's length times the bucket's greatest length stays below
  the threshold (Cauchy-Schwarz), and with it all shorter buckets of the task;
* inside a bucket only documents that hold one of the query's focus coordinates can
  reach the threshold; from these coordinates and what length is left for the others
  each has an upper bound, and those below the threshold go;
* the survivors are scored in 64-bit integers.

Thresholds start from the longest vectors of all.  Items are a stated query set, handled
in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlens.session import written

#: Bytes outside terms become blanks, A-Z become a-z, all else stays.
_TABLE = bytes(c if c >= 128 or 48 <= c < 58 or 97 <= c < 123 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
#: Best documents of an item.
TOP = 10
#: Vectors of a bucket.
BUCKET = 2048
#: Longest vectors that give the first thresholds.
HEAD = 4096
#: UTF-8 bytes of the item texts of a block.
BLOCK_BYTES = 16 << 20
#: Rounding of the bounds' floating-point sums.
_SLACK = 1 + 1e-9


def terms(text: str | None) -> list[bytes]:
    """Maximal rows of digits, letters and everything beyond ASCII; only A-Z is lowered."""
    return text.encode().translate(_TABLE).split() if text else []


def _item_blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """``(number, distinct terms)`` of the items, block by block."""
    rows = items.select(F.col("__q"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    count = -(-size // BLOCK_BYTES) or 1
    for k in range(count):
        own = rows.where(F.pmod(F.xxhash64("__q"), F.lit(count)) == k).collect() if count > 1 else rows.collect()
        found = [(r["__q"], sorted(set(terms(r.text)))) for r in own]
        yield [f for f in found if f[1]]


def _counts(docs: DataFrame, key: str, text: str, numbers: dict[bytes, int]) -> DataFrame:
    """``(id, n, term, tf)``: length of each document, and how often it holds the numbered terms."""
    held = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                b = whole.slice(start, 1000)
                n, ends, found, often = [], [0], [], []
                for t in b.column("text").to_pylist():
                    words = terms(t)
                    n.append(len(words))
                    count = Counter(words)
                    own = sorted((known[w], count[w]) for w in count.keys() & known.keys())
                    found += [x for x, _ in own]
                    often += [x for _, x in own]
                    ends.append(len(found))
                ends = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (found, often)]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), *lists], names=["id", "n", "term", "tf"])

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {rows.dtypes[0][1]}, n long, term array<int>, tf array<int>")


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _vectors(counts: DataFrame, weights: np.ndarray, n_docs: int, total: int) -> DataFrame:
    """``(id, length, term, impact)`` of the documents with an impact above 0."""
    held = counts.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        for b in batches:
            lists = b.column("term")
            sizes = np.diff(lists.offsets.to_numpy())
            at, tf = lists.flatten().to_numpy(), b.column("tf").flatten().to_numpy().astype(np.int64)
            n = b.column("n").to_numpy()
            m = 10 + 90 * n * n_docs // total
            impact = w[at] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes)))
            row, keep = np.repeat(np.arange(len(n)), sizes), impact > 0
            row, at, impact = row[keep], at[keep], impact[keep]
            length = np.sqrt(np.bincount(row, np.square(impact.astype(float)), len(n)))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n)))]).astype(np.int32))
            made = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (at, impact)]
            out = pa.RecordBatch.from_arrays([b.column("id"), pa.array(length), *made], names=["id", "length", "term", "impact"])
            yield out.filter(pa.array(length > 0))

    return counts.mapInArrow(run, f"id {counts.dtypes[0][1]}, length double, term array<int>, impact array<long>")


class _Bucket:
    """Vectors of like length by coordinate: rows and impacts of each term, and the greatest impact."""

    def __init__(self, b: pa.RecordBatch):
        lists = b.column("term")
        sizes = np.diff(lists.offsets.to_numpy())
        at = lists.flatten().to_numpy()
        order = np.argsort(at, kind="stable")
        self.rows = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.impact = b.column("impact").flatten().to_numpy()[order]
        self.terms, starts = np.unique(at[order], return_index=True)
        self.starts = np.append(starts, len(at))
        self.most = np.maximum.reduceat(self.impact, starts) if len(at) else np.zeros(0, np.int64)
        self.length = b.column("length").to_numpy()
        self.longest = float(self.length.max())
        self.ids = b.column("id")

    def survivors(self, query: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose score may reach ``least``, and their exact scores."""
        k = np.searchsorted(self.terms, query)
        k = k[(k < len(self.terms)) & (self.terms[np.minimum(k, len(self.terms) - 1)] == query)]
        k = k[np.argsort(-self.most[k], kind="stable")]
        # what the coordinates from each on can add at most: by their greatest impacts, or by length
        rest = np.append(np.cumsum(self.most[k][::-1])[::-1], 0)
        left = np.arange(len(k), -1, -1)
        rest = np.minimum(rest, np.sqrt(left) * self.longest * _SLACK)
        if rest[0] < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        focus = max(1, int(np.argmax(rest < least))) if rest[-1] < least else len(k)
        score, square = np.zeros(len(self.length), np.int64), np.zeros(len(self.length))
        for t in k[:focus]:
            s = slice(self.starts[t], self.starts[t + 1])
            score[self.rows[s]] += self.impact[s]
            square[self.rows[s]] += np.square(self.impact[s].astype(float))
        more = np.sqrt(np.maximum(self.length**2 * _SLACK - square, 0) * left[focus]) * _SLACK
        alive = np.flatnonzero((score > 0) & (score + np.minimum(more, rest[focus]) >= least))
        out = score[alive]
        for t in k[focus:]:
            rows, impact = self.rows[self.starts[t] : self.starts[t + 1]], self.impact[self.starts[t] : self.starts[t + 1]]
            if len(rows) and len(alive):
                p = np.minimum(np.searchsorted(rows, alive), len(rows) - 1)
                out = out + np.where(rows[p] == alive, impact[p], 0)
        return alive, out


def _best(vectors: DataFrame, queries: list[tuple[int, np.ndarray]], first: dict[int, int], top: int) -> DataFrame:
    """``(q, id, score)``: the best documents of each query in each task; the longest vectors come first."""
    held = vectors.sparkSession.sparkContext.broadcast((queries, first))
    name = vectors.dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, first = held.value
        best: dict[int, list[tuple]] = {q: [] for q, _ in queries}
        least = {q: max(1, first.get(q, 1)) for q, _ in queries}
        reach = {q: math.sqrt(len(t)) * _SLACK for q, t in queries}
        asking = queries
        for b in batches:
            for start in range(0, b.num_rows if asking else 0, BUCKET):
                bucket = _Bucket(b.slice(start, BUCKET))
                asking = [(q, t) for q, t in asking if reach[q] * bucket.longest >= least[q]]
                if not asking:
                    break
                for q, t in asking:
                    rows, score = bucket.survivors(t, least[q])
                    good = score >= least[q]
                    if not good.any():
                        continue
                    ids = bucket.ids.take(pa.array(rows[good])).to_pylist()
                    mine = best[q] + [(-s, i is None, i) for s, i in zip(score[good].tolist(), ids, strict=True)]
                    mine.sort(key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))
                    best[q] = mine[:top]
                    if len(mine) >= top:
                        least[q] = max(least[q], -best[q][-1][0])
        rows = [(q, i, -s) for q, own in best.items() for s, _, i in own]
        q, i, s = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, kind[0]), pa.array(s, pa.int64())], names=["q", "id", "score"])

    kind = [vectors.sparkSession.createDataFrame([], f"id {name}").toArrow().schema.field("id").type]
    return vectors.mapInArrow(run, f"q long, id {name}, score long")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """``(item key, rank, document key, score)``: the ``top`` best documents of every item, score above 0.

    Equal scores go by ascending key, rows without a key last; repeated rows each take
    a rank.  Null and empty texts have no terms: such a document is in no result and does
    not count as a document, such an item has no rows.  Items that share an id are
    ranked on their own.  Other columns are not read.
    """
    spark = docs.sparkSession
    numbered = written(items.select(F.monotonically_increasing_id().alias("__q"), F.col(item_key).alias("__item"), F.col(item_text).alias(item_text)), "items")
    found = None
    for block in _item_blocks(numbered, "__q", item_text):
        words = sorted({w for _, own in block for w in own})
        numbers = {w: k for k, w in enumerate(words)}
        counts = written(_counts(docs, key, text, numbers), "counts")
        n_docs, total = counts.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = counts.select(F.explode("term").alias("term")).groupBy("term").count().toArrow()
        weights = np.zeros(len(words) + 1, np.int64)
        for t, df in zip(held.column(0).to_pylist(), held.column(1).to_pylist(), strict=True):
            weights[t] = weight(n_docs, df)
        queries = [(q, np.array([numbers[w] for w in own], np.int32)) for q, own in block]
        vectors = written(_vectors(counts, weights, n_docs, max(total, 1)), "vectors")
        order = [F.desc("length"), F.asc("tie")]
        tied = vectors.withColumn("tie", F.xxhash64("id"))
        head = _best(tied.orderBy(*order).limit(HEAD).drop("tie"), queries, {}, top).groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        first = {r.q: r.least for r in head.where(F.col("n") >= top).collect()}
        laid = tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
        own = _best(laid, queries, first, top)
        found = own if found is None else found.union(own)
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").isNull(), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    names = numbered.select(F.col("__q").alias("q"), F.col("__item").alias(item_key))
    return ranked.join(names, "q").select(item_key, "rank", F.col("id").alias(key), "score")


#: The same rows in SQL, over all pairs of a document and an item that share a term.
SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS qid, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
q AS (SELECT qid, item_id, unnest(w) AS term FROM i),
t AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
c AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
f AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT n FROM c) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t GROUP BY term),
v AS (SELECT t.rid, t.term, f.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * len(d.w) * c.n) // c.l))) AS x
  FROM t JOIN f USING (term) JOIN d USING (rid) CROSS JOIN c),
s AS (SELECT q.qid, q.item_id, v.rid, CAST(sum(v.x) AS BIGINT) AS score FROM q JOIN v USING (term) GROUP BY ALL HAVING sum(v.x) > 0),
r AS (SELECT s.item_id, CAST(row_number() OVER (PARTITION BY s.qid ORDER BY s.score DESC, d.doc_id) AS INTEGER) AS rank, d.doc_id, s.score FROM s JOIN d USING (rid))
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
