"""N-gram Jaccard join with signature trees, and the groups its links form.

Documents with one shingle set are one node.  Nodes that must be compared meet in buckets
by a prefix filter: each sends the rarest fifth of its shingles, so two sets with
similarity 0.8 share one of them.  A bucket is a signature tree: leaves hold nodes with a
token bitmap and a size, inner tree nodes the OR of the bitmaps below and the range of
sizes.  A dual traversal drops pairs of subtrees whose largest possible overlap is too
small, or that already are one group.  Survivors are compared exactly.

Copies of a text that differ a little would fill buckets with pairs that all link.  So
nodes are first compared with one pivot for each of their smallest shingles, the holder whose
smallest shingles are the most common: the copy that is least changed.  What links there is
one group before the buckets are made.  What is near a group but links with nothing in it
meets it in crowded buckets only, and there larger bitmaps tell most such pairs apart.

What a bucket gives does not grow with the square of its members.  The place of its token in
a prefix bounds the overlap of a pair, and crowded buckets bring whole sets: their pairs are
compared exactly inside the task, and a pair whose groups are linked by then adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens.llm.common import attach, components, small_batches, word_hashes
from scanlens.session import drop_path, shared_folder, written

WORDS = 5
#: Two sets link if ``100 * overlap >= PERCENT * union``.
PERCENT = 80
#: Bits of a signature: the power of two not below twice the set size, within these limits.
LEAST_BITS, MOST_BITS = 64, 1 << 17
#: The same in crowded buckets, where bounds that are not sharp would leave pairs by the square.
WIDE = 8
#: Smallest shingles of a node that look for a pivot, and how many must find the same one.
PIVOTS, AGREE = 8, 3
#: Further pivots for a node that the first one does not link.
MORE_PIVOTS = 6
#: Shingles in more nodes than this are put last in the order of the prefix filter, and their buckets are crowded.
CROWDED = 64
#: Cells that crowded shingles are hashed to; a bitmap of them (8 MB) goes to the tasks.
#: A wrongly marked shingle changes the order of the filter, never its result.
CELL_BITS = 26
#: Nodes of a bucket handled by one tree; larger buckets are cut into blocks that meet pairwise.
BLOCK = 512
#: Entries of a leaf and subtrees of an inner tree node.
FANOUT = 8
#: First buckets of a node that tell where a pair has been met before.
KNOWN = 8
#: Larger sets do not travel to crowded buckets (64 KB each); their pairs are left to the comparison of texts.
LISTED = 8192

_PLACE = np.random.default_rng(5).integers(0, 2**64, WORDS, np.uint64) | np.uint64(1)


_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 32]] = True


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than five are one shingle.

    Words are cut at ASCII white space, and only A-Z is lowered.
    """
    raw = np.frombuffer(text.encode().lower(), np.uint8)
    edge = np.flatnonzero(np.diff(_BLANK[raw], prepend=True, append=True))
    if not len(edge):
        return np.zeros(0, np.uint64)
    w = word_hashes(raw, edge[::2], edge[1::2])
    n = min(WORDS, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h += w[j : len(h) + j] * _PLACE[j]
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    h = np.sort(h ^ (h >> np.uint64(33)))
    return h[np.append(True, h[1:] != h[:-1])]


def width(n: int, times: int = 2) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, times * n - 1).bit_length()))


def bitmap(tokens: np.ndarray, times: int = 2) -> bytes:
    """One bit for each token, lowest bit first; the halves of a bitmap can be folded onto each other."""
    bits = np.zeros(width(len(tokens), times), bool)
    bits[(tokens & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both)


def prefix_length(n: int) -> int:
    """Shingles of which two linked sets share at least one, in any common order."""
    return n - -(-PERCENT * n // 100) + 1


class Tree:
    """A node of a signature tree: OR of bitmaps, sizes, spare elements, common group."""

    __slots__ = ("bits", "least", "most", "spare", "group", "below", "entry")

    def __init__(self, bits: int, least: int, most: int, spare: int, group: int | None, below: list[Tree], entry: int = -1):
        self.bits, self.least, self.most, self.spare, self.group, self.below, self.entry = bits, least, most, spare, group, below, entry


def plant(rows: list[tuple[int, int, int, bytes]], bits_wide: int) -> Tree:
    """Tree of ``(node, group, size, bitmap)`` rows, bitmaps folded to one width; neighbours are near in size."""
    level = []
    for node, group, n, sig in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        bits, wide = int.from_bytes(sig, "little"), 8 * len(sig)
        while wide > bits_wide:
            wide //= 2
            bits = bits >> wide | bits & ((1 << wide) - 1)
        level.append(Tree(bits, n, n, n - bits.bit_count(), group, [], node))
    while len(level) > 1:
        above = []
        for i in range(0, len(level), FANOUT):
            part = level[i : i + FANOUT]
            bits = 0
            for t in part:
                bits |= t.bits
            groups = {t.group for t in part}
            above.append(Tree(bits, min(t.least for t in part), max(t.most for t in part), max(t.spare for t in part), groups.pop() if len(groups) == 1 else None, part))
        level = above
    return level[0]


def hopeless(a: Tree, b: Tree) -> bool:
    """No pair of entries below can link, or all of them are one group already.

    Shared elements lie on shared bits; an entry has at most ``spare`` elements more
    than bits.
    """
    if a.group is not None and a.group == b.group:
        return True
    if 100 * a.most < PERCENT * b.least or 100 * b.most < PERCENT * a.least:
        return True
    overlap = min((a.bits & b.bits).bit_count() + min(a.spare, b.spare), a.most, b.most)
    return (100 + PERCENT) * overlap < PERCENT * (a.least + b.least)


def traverse(a: Tree, b: Tree) -> Iterator[tuple[int, int]]:
    """Pairs of entries, one from each tree (or both from ``a`` if it is ``b``), that are not ruled out."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if hopeless(x, y):
            continue
        if not x.below and not y.below:
            if x is not y:
                yield min(x.entry, y.entry), max(x.entry, y.entry)
        elif x is y:
            stack += combinations(x.below, 2)
            stack += ((t, t) for t in x.below if t.below)
        else:
            stack += product(x.below or [x], y.below or [y])


def pairs_of(left: list[tuple[int, int, int, bytes]], right: list[tuple[int, int, int, bytes]] | None = None) -> Iterator[tuple[int, int]]:
    """Pairs of rows of one list, or of two, that trees do not rule out.

    Rows of one bitmap width share a tree.  Linked sets differ by a quarter in size at
    most, so trees of other widths meet only if one is twice the other.
    """
    sides = [_by_width(rows) for rows in ([left] if right is None else [left, right])]
    for wide, rows in sides[0].items():
        tree = plant(rows, wide)
        if right is None:
            yield from traverse(tree, tree)
            if 2 * wide in sides[0]:
                yield from traverse(tree, plant(sides[0][2 * wide], wide))
        else:
            for other, more in sides[1].items():
                if other in (wide, 2 * wide):
                    yield from traverse(tree, plant(more, wide))
                elif 2 * other == wide:
                    yield from traverse(plant(rows, other), plant(more, other))


def _by_width(rows: list[tuple[int, int, int, bytes]]) -> dict[int, list]:
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(8 * len(r[3]), []).append(r)
    return found


def _batch(columns: dict[str, tuple[list | np.ndarray, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], names=list(columns))


def _marks(docs: DataFrame) -> DataFrame:
    """``(id, print, n, set, sig, small)`` of every row of ``(id, print, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            n, sets, sigs, small = [], [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t or "")
                n.append(len(s))
                sets.append(xxhash.xxh3_128_digest(s.tobytes()))
                sigs.append(bitmap(s))
                small.append(s[:PIVOTS].view(np.int64))
            new = [pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary()), pa.array(small, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("print"), *new], names=["id", "print", "n", "set", "sig", "small"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, print long, n long, set binary, sig binary, small array<long>")


def _central(nodes: DataFrame) -> DataFrame:
    """``(node, n, small, far)`` of the nodes that share one of their smallest shingles; ``far`` is least where those are the most common."""
    rows = nodes.select("node", F.explode("small").alias("token"))
    common = rows.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    far = rows.join(common, "token").groupBy("node").agg(F.sum(-F.floor(F.log2("c"))).alias("far"))
    return nodes.select("node", "n", "small").join(far, "node")


def _pivot_pairs(nodes: DataFrame, asking: DataFrame, rounds: range) -> DataFrame:
    """``(a, b)``: asking nodes, and the pivots that several of their smallest shingles agree on.

    Nodes are those of ``_central``.  Round 0 takes the most central node of every shingle,
    each other round draws one by a hash of its own.
    """
    rows = nodes.select("node", "n", "far", F.explode("small").alias("token"))
    drawn = [F.min(F.struct((F.lit(0).cast("long") if r else F.col("far")).alias("far"), F.xxhash64(F.lit(r), "node").alias("h"), "node", "n")).alias(f"p{r}") for r in rounds]
    pivots = rows.groupBy("token").agg(F.count("*").alias("c"), *drawn).where("c > 1").select("token", F.array(*(f"p{r}" for r in rounds)).alias("p"))
    mine = asking.select("node", "n", F.explode("small").alias("token"))
    near = mine.join(pivots, "token").select("node", "n", "token", F.explode(F.array_distinct("p")).alias("p"))
    near = near.where(f"node <> p.node and 100 * least(n, p.n) >= {PERCENT} * greatest(n, p.n)")
    return near.groupBy(F.col("node").alias("a"), F.col("p.node").alias("b"), "n").count().where(f"count >= least({AGREE}, (n + 1) div 2)").select("a", "b")


def _verified(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose sets link, compared exactly.

    The text of ``a`` travels once for each pair, the text of ``b`` once; a pivot with
    very many pairs is a crowded partition of a plain join, which the engine splits.
    """
    pairs = written(pairs.distinct(), "pairs")
    left = attach(reps.withColumnRenamed("node", "a"), pairs, ["a"], "inner").select("a", "b", F.col("text").alias("left"))
    wanted = written(pairs.select("b").distinct(), "pivots")
    right = attach(reps.withColumnRenamed("node", "b"), wanted, ["b"], "inner").select("b", F.col("text").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, 250):
            keep, last, pivot = [], None, None
            for k, x, y in zip(b.column("b").to_pylist(), b.column("left").to_pylist(), b.column("right").to_pylist(), strict=True):
                if k != last:
                    last, pivot = k, shingles(y)
                keep.append(similar(shingles(x), pivot))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return left.join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that the shingles of few texts are held at a time."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)


def _lowest(reps: DataFrame) -> DataFrame:
    """``key`` for the lowest quarter of each node's shingles: the upper half of the shingle, which holds its cell.

    Shingles that share a half are counted as one; that may mark a cell wrongly, and is half of what would travel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            tokens = [s[: len(s) // 4 + 1] for s in (shingles(t) for t in b.column("text").to_pylist())]
            yield _batch({"key": ((np.concatenate(tokens) >> np.uint64(32)).astype(np.uint32).view(np.int32), pa.int32())})

    return reps.select("text").mapInArrow(run, "key int")


def _cells(keys: DataFrame) -> np.ndarray:
    """Bitmap of the cells of some keys, as 64-bit words; at most 2^CELL_BITS bits reach the driver."""
    cell = F.shiftrightunsigned("key", 32 - CELL_BITS)
    words = keys.groupBy(F.shiftright(cell, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, shiftrightunsigned(key, {32 - CELL_BITS}) & 63)")).alias("bits"))
    out = np.zeros(1 << (CELL_BITS - 6), np.uint64)
    found = words.toArrow()
    out[found.column("w").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _marked(cells: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = tokens >> np.uint64(64 - CELL_BITS)
    return (cells[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _prefixes(reps: DataFrame, crowded: np.ndarray) -> DataFrame:
    """``(token, at, n, node, group)`` for the prefix of every node; crowded shingles come last in the order, ``at`` is the place in it."""
    held = reps.sparkSession.sparkContext.broadcast(crowded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            tokens, full = [], []
            for t in b.column("text").to_pylist():
                s = shingles(t)
                full.append(len(s))
                late = _marked(held.value, s)
                tokens.append(np.concatenate([s[~late], s[late]])[: prefix_length(len(s))])
            sizes = [len(t) for t in tokens]
            at = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
            n = np.repeat(np.array(full, np.int32), sizes)
            yield _batch({"token": (np.concatenate(tokens).view(np.int64), pa.int64()), "at": (at, pa.int32()), "n": (n, pa.int32()), **{c: (np.repeat(b.column(c).to_numpy(), sizes), pa.int64()) for c in ("node", "group")}})

    return reps.mapInArrow(run, "token long, at int, n int, node long, group long")


def _wide(reps: DataFrame) -> DataFrame:
    """``(node, wide, whole)``: the bitmaps of crowded buckets, and the sets; larger ones than ``LISTED`` are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            sets = [shingles(t) for t in b.column("text").to_pylist()]
            wide, whole = [bitmap(s, WIDE) for s in sets], [s.tobytes() if len(s) <= LISTED else None for s in sets]
            yield _batch({"node": (b.column("node"), pa.int64()), "wide": (wide, pa.binary()), "whole": (whole, pa.binary())})

    return reps.select("node", "text").mapInArrow(run, "node long, wide binary, whole binary")


def _mixed(prefixes: DataFrame) -> DataFrame:
    """The rows whose token is in nodes of two groups; the prefixes, which are many more, are dropped then."""
    spark = prefixes.sparkSession
    path = shared_folder(spark, "prefixes")
    prefixes.write.parquet(path)
    rows = spark.read.parquet(path)
    mixed = rows.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("token")
    members = written(attach(rows, written(mixed, "mixed"), ["token"], "inner"), "members")
    drop_path(spark, path)
    return members


def _living(rows: DataFrame) -> DataFrame:
    """The rows of buckets that some pair of two groups may need.

    At the first token that a linked pair shares, the shared elements are at most what is
    left of either set from there.  So the smaller set is not far from its start there, and the
    larger one has enough left for the least such set of the bucket.
    """
    left = f"{100 + PERCENT}L * (n - at)"
    least = rows.where(f"{left} >= {2 * PERCENT}L * n").groupBy("token").agg(F.min("n").alias("least"))
    rows = attach(rows, written(least, "least-sizes"), ["token"], "inner").where(f"{left} >= {PERCENT}L * (n + least)")
    return rows.drop("least")


def _bucket_pairs(rows: DataFrame, nodes: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs that the buckets do not rule out, without those that join no groups.

    Rows are those of ``_mixed``: buckets inside one group need no comparison, nor do rows that
    can reach no other (``_living``).  Buckets with the same members are one, that of the token
    which comes first.  Rows of crowded buckets bring bitmaps of ``WIDE`` times the set size,
    and their sets.  A pair is given by the first bucket that both nodes share: every row
    brings the buckets its node has before, and a pair that shares one of them is left to it.
    """
    rows = written(_living(rows), "living")
    tokens = rows.groupBy("token").agg(F.count("*").alias("c"), F.min("at").alias("at"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(3), "node")).alias("y"), F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi")
    buckets = tokens.groupBy("x", "y", "c").agg(F.min_by("token", "at").alias("token"))  # all members have them in one order
    buckets = written(buckets.select("token", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"), (F.col("c") > CROWDED).alias("crowded")), "buckets")
    met = written(attach(rows, buckets, ["token"], "inner"), "met")
    crowd = written(met.where("crowded").select("node").distinct(), "crowd")
    wide = written(_wide(attach(reps, crowd, ["node"], "inner")), "wide")
    few = met.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("at", "token"))), 1, KNOWN).alias("few"))  # a prefix at most
    met = met.join(few.join(nodes.select("node", "sig"), "node"), "node")
    met = met.withColumn("few", F.expr("transform(filter(few, x -> x.at < at), x -> x.token)"))
    met = attach(met, wide, ["node"]).withColumns({"sig": F.when(F.col("crowded"), F.col("wide")).otherwise(F.col("sig")), "whole": F.when(F.col("crowded"), F.col("whole"))})
    own = F.pmod(F.xxhash64(F.lit(11), "node"), F.col("blocks")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    met = met.select("token", "i", "j", "own", "few", "at", "whole", "node", "group", "n", "sig").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for b in _slices(batches):
            found: list[tuple[int, int]] = []
            for token, i, j, own, few, at, whole, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (token, i, j) != bucket:
                    found += _pairs(bucket, held)
                    bucket, held = (token, i, j), []
                held.append(Member(own, set(few), at, whole, tuple(row)))
            yield _batch({"a": ([p[0] for p in found], pa.int64()), "b": ([p[1] for p in found], pa.int64())})
        found = _pairs(bucket, held)
        yield _batch({"a": ([p[0] for p in found], pa.int64()), "b": ([p[1] for p in found], pa.int64())})

    return met.mapInArrow(run, "a long, b long").distinct()


class Member(NamedTuple):
    """A row of a bucket: its block, the node's buckets before this one, the token's place, the set if it came along, and the row of a tree."""

    own: int
    before: set[int]
    at: int
    whole: bytes | None
    row: tuple[int, int, int, bytes]


def reaches(a: Member, n: int, least: int) -> bool:
    """Whether ``n`` shared elements at most can link a member with a set of ``least`` elements."""
    return (100 + PERCENT) * n >= PERCENT * (a.row[2] + least)


def _pairs(bucket: tuple[int, int, int] | None, held: list[Member]) -> list[tuple[int, int]]:
    """Pairs of a bucket, or of two of its blocks, that may link, belong to it and join two groups.

    The token is the first that a pair of this bucket shares: what stands before it is in one
    set only.  If both sets came along the pair is compared exactly, and given only if its
    groups are not joined by the pairs that were found to link before.
    """
    least = min((m.row[2] for m in held), default=0)
    held = [m for m in held if reaches(m, m.row[2] - m.at, least)]
    if len(held) < 2:
        return []
    _, i, j = bucket
    by = {m.row[0]: m for m in held}
    if i == j:
        found = pairs_of([m.row for m in held])
    else:
        left, right = ([m.row for m in held if m.own == k] for k in (i, j))
        found = pairs_of(left, right) if left and right else ()
    above: dict[int, int] = {}
    out = []
    for a, b in found:
        x, y = by[a], by[b]
        if not reaches(x, min(x.row[2] - x.at, y.row[2] - y.at), y.row[2]) or not x.before.isdisjoint(y.before):
            continue
        if x.whole is not None and y.whole is not None:
            p, q = _top(above, x.row[1]), _top(above, y.row[1])
            if p == q or not similar(np.frombuffer(x.whole, np.uint64), np.frombuffer(y.whole, np.uint64)):
                continue
            above[p] = q
        out.append((a, b))
    return out


def _top(above: dict[int, int], group: int) -> int:
    """The group that stands for all that a group has been joined with."""
    while group in above:
        above[group] = group = above.get(above[group], above[group])
    return group


def join_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: rows ``(id, print, n, component_id)`` and kept rows ``(id, print)``, one of each group.

    Every input row has one row in the first.  ``n`` is its set size and ``component_id``
    the smallest id reachable by links, itself included.  A null or empty text has an
    empty set and is linked with nothing: its component is its own id.  Null ids count
    as largest, and a group of null ids alone has a null component.  Rows with equal
    text, or with one set of shingles, are always linked; repeated rows too.  Other
    columns are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    base = small_batches(docs).select(F.col(key).alias("id"), F.xxhash64(body).alias("print"), body.alias("text"))
    marks = written(_marks(base), "marks")
    first = F.min(F.struct(F.col("id").isNull().alias("void"), "id", "print"))
    groups = marks.where("n > 0").groupBy("set").agg(first.alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("small").alias("small"))
    nodes = written(groups.select(F.monotonically_increasing_id().alias("node"), "set", F.col("rep.id").alias("id"), F.col("rep.print").alias("print"), "n", "sig", "small"), "nodes")
    known = nodes.where("id is not null").select("id", "print", "node")
    lone = nodes.where("id is null").select("print", "node")
    reps = attach(base, known, ["id", "print"], "inner").select("node", "text").union(attach(base.where("id is null"), lone, ["print"], "inner").select("node", "text"))
    reps = written(reps.dropDuplicates(["node"]) if _repeated(marks) else reps, "reps")

    central = written(_central(nodes), "central")
    tried = written(_pivot_pairs(central, central, range(1)), "pivot-pairs")
    near = written(_verified(tried, reps), "links")
    # what found a pivot but no link asks further pivots
    lone = tried.select(F.col("a").alias("node")).distinct().join(near.select(F.col("a").alias("node")), "node", "left_anti")
    lone = attach(nodes.select("node", "n", "small"), written(lone, "lone"), ["node"], "inner")
    near = near.union(written(_verified(_pivot_pairs(central, lone, range(1, 1 + MORE_PIVOTS)), reps), "links"))
    found = written(components(spark, near).select("node", F.col("comp").alias("group")), "groups")
    grouped = attach(reps, found, ["node"]).withColumn("group", F.coalesce("group", "node"))
    often = _lowest(reps).groupBy("key").count().where(f"count > {CROWDED}")
    rows = _mixed(_prefixes(grouped, _cells(often)))
    more = written(_verified(_bucket_pairs(rows, nodes, reps), reps), "links")

    joined = written(components(spark, near.union(more)).select("node", "comp"), "components")
    mine = attach(nodes.select("node", "set", "id", "print"), joined, ["node"]).withColumn("comp", F.coalesce("comp", "node"))
    least = written(mine.groupBy("comp").agg(first.alias("rep")).select("comp", F.col("rep.id").alias("component_id"), F.col("rep.print").alias("rep_print")), "least")
    sets = written(attach(mine.select("set", "comp"), least, ["comp"]).select("set", "component_id"), "sets")
    out = attach(marks.select("id", "print", "n", "set"), sets, ["set"])
    out = out.select("id", "print", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return out, least.select(F.col("component_id").alias("id"), F.col("rep_print").alias("print"))


def _repeated(marks: DataFrame) -> bool:
    """Whether any row occurs twice with id and text."""
    return bool(marks.groupBy("id", "print").count().where("count > 1").limit(1).count())


def link_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id."""
    rows, _ = join_documents(docs, key, text)
    return rows.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the others of their group: the one with the smallest id stays.

    Documents without words are in no group and stay.  Of rows repeated with id and text
    one stays.  Columns are unchanged.
    """
    rows, kept = join_documents(docs, key, text)
    empty = rows.where("n = 0").select("id", "print")
    keep = written(kept.union(empty).distinct(), "kept").select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("__id"), F.col("print").alias("__print"))
    mine = docs.withColumns({"__id": F.coalesce(F.col(key).cast("string"), F.lit("")), "__print": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    out = attach(mine, keep, ["__id", "__print"], "left_semi").select(*docs.columns)
    return out.dropDuplicates([key, text]) if _repeated(rows) else out


#: Shingle sets, links and components in SQL; the recursion spreads the smallest id along links.
LINKS_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT rid, hash(array_to_string(w[i:i + least(len(w), 5) - 1], ' ')) AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
o AS (SELECT a.rid AS a, b.rid AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r(rid, seen) AS (SELECT rid, rid FROM d UNION SELECT l.b, r.seen FROM r JOIN l ON l.a = r.rid),
c AS (SELECT r.rid, min(d.doc_id) AS component_id FROM r JOIN d ON d.rid = r.seen GROUP BY r.rid)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id FROM d LEFT JOIN n USING (rid) JOIN c USING (rid)
"""
