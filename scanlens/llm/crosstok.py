"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled whole, equal ones combined before the exchange and counted.  Each
distinct text is encoded by a byte-level BPE (A) and a SentencePiece model (B); where
tokens of both end at one byte, the text is cut into groups.  A pair of tokens is linked
if their byte ranges share a group.  Counts of id pairs over the corpus weight each text
by its multiplicity; measures return to the documents by a 128-bit digest of the text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlens.llm.common import attach
from scanlens.session import written

SPACE = "▁"
#: Splits a text into the words that byte-level merges stay inside.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Groups with more links than this are reduced to distinct ids before they are paired.
DENSE = 64
#: Pairs of one output row; a text with more has further rows.
PAIRS = 1 << 20
#: Texts of an output batch.
TEXTS = 500


def _byte_of() -> dict[str, int]:
    """Byte behind each character of a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteLevel:
    """Byte-level BPE from a tokenizer file: ids and the bytes of each id.

    Files whose ids follow the merges, with the usual word pattern and no added steps,
    run as ranks; others, and texts that the rank encoder cannot take, run in the
    tokenizer library itself.  Both give the same ids.
    """

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(blob)
        known = _byte_of()
        vocab = spec["model"]["vocab"]
        special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *special]) + 1
        self.bytes = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(known[c] for c in token) if i not in special else special[i]
        self.library = Tokenizer.from_str(blob.decode())
        self.library.encode_special_tokens = True
        self.ranks = None
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
        level = spec.get("pre_tokenizer") or {}
        plain = not spec.get("normalizer") and level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and level.get("use_regex", True)
        if plain and None not in merged and merged == sorted(merged) and all(vocab.get(c) is not None for c in known):
            import tiktoken

            ranks = {self.bytes[i]: i for i in vocab.values() if i not in special}
            self.ranks = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.ranks is not None:
            try:
                return self.ranks.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            except BaseException as error:  # very long white space overflows the pattern's stack
                if type(error).__name__ != "PanicException" and not isinstance(error, ValueError):
                    raise
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """SentencePiece model: ids without end or start, and the bytes of each id."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


class Alignment:
    """Tokens of one text by both tokenizers, and the groups that common ends cut."""

    def __init__(self, a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray):
        self.a, self.b = a, b
        end_a, end_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
        seen = np.zeros(int(end_a[-1]) + 1, np.uint8)
        seen[end_a] = 1
        seen[end_b] |= 2
        last_a, last_b = seen[end_a] == 3, seen[end_b] == 3
        self.group_a = np.cumsum(last_a) - last_a
        self.group_b = np.cumsum(last_b) - last_b
        self.groups = int(last_a.sum())
        self.count_a = np.bincount(self.group_a, minlength=self.groups)
        self.count_b = np.bincount(self.group_b, minlength=self.groups)
        self.links = int((self.count_a * self.count_b).sum())

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides group by group, and what stands before each: 0 ``,`` 1 ``;`` 2 ``|``."""
        before_b = np.cumsum(self.count_b) - self.count_b
        upto_a = np.cumsum(self.count_a)
        at_a = np.arange(len(self.a)) + before_b[self.group_a]
        at_b = np.arange(len(self.b)) + upto_a[self.group_b]
        ids, lead = np.empty(len(self.a) + len(self.b), np.int64), np.zeros(len(self.a) + len(self.b), np.int64)
        ids[at_a], ids[at_b] = self.a, self.b
        lead[at_a[upto_a - self.count_a]] = 1
        lead[at_b[before_b]] = 2
        return ids, lead

    def pairs(self, most: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct linked id pairs ``a << 32 | b`` with their occurrences, at most about ``most`` at a time.

        No pair comes twice: what is too much for one part is cut by ranges of A ids.
        """
        rows_a = _grouped(self.group_a, self.a, self.count_a * self.count_b)
        rows_b = _grouped(self.group_b, self.b, self.count_a * self.count_b)
        start = np.searchsorted(rows_b[0], np.arange(self.groups + 1))
        width = np.diff(start)[rows_a[0]]
        if width.sum() <= most:
            yield _paired(rows_a, rows_b, start, width)
            return
        order = np.argsort(rows_a[1], kind="stable")
        rows_a, width = tuple(x[order] for x in rows_a), width[order]
        firsts = np.flatnonzero(np.r_[True, np.diff(rows_a[1]) > 0])
        load = np.add.reduceat(width, firsts)
        part, ends = (np.cumsum(load) - load) // most, np.append(firsts[1:], len(width))
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            s = slice(firsts[own[0]], ends[own[-1]])
            yield _paired(tuple(x[s] for x in rows_a), rows_b, start, width[s])


def _grouped(group: np.ndarray, ids: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(group, id, times)`` in order of groups; groups with many links have each id once."""
    dense = (links > DENSE)[group]
    if not dense.any():
        return group, ids, np.ones(len(ids), np.int64)
    key, times = np.unique(group[dense] << 32 | ids[dense], return_counts=True)
    own = np.concatenate([group[~dense], key >> 32]), np.concatenate([ids[~dense], key & 0xFFFFFFFF]), np.concatenate([np.ones((~dense).sum(), np.int64), times])
    order = np.argsort(own[0], kind="stable")
    return tuple(x[order] for x in own)


def _paired(rows_a: tuple, rows_b: tuple, start: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = np.repeat(np.arange(len(width)), width)
    right = np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width) + start[rows_a[0]][left]
    pair, inverse = np.unique(rows_a[1][left] << 32 | rows_b[1][right], return_inverse=True)
    return pair, np.bincount(inverse, rows_a[2][left] * rows_b[2][right], len(pair)).astype(np.int64)


class Aligner:
    """Both tokenizers, and the bytes and digits of their ids."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        self.first, self.second = ByteLevel(byte_level), Pieces(pieces)
        self.len_a, self.len_b = (np.array([len(x) for x in side.bytes], np.int64) for side in (self.first, self.second))
        most = max(len(self.len_a), len(self.len_b))
        self.size, self.said = most, [f"{c}{i}" for c in ",;|" for i in range(most)]

    def align(self, text: str | None) -> Alignment | None:
        """None for an empty text, or one that the tokens of a side do not spell."""
        if not text:
            return None
        raw = f" {text}".encode()
        a, b = self.first.encode(f" {text}"), self.second.encode(text)
        for ids, known in ((a, self.first.bytes), (b, self.second.bytes)):
            if b"".join(map(known.__getitem__, ids.tolist())) != raw:
                return None
        return Alignment(a, b, self.len_a, self.len_b)

    def digest(self, found: Alignment) -> str:
        """SHA-256 of the groups as ``a1,a2|b1;a3|b2,b3``."""
        ids, lead = found.codes()
        return hashlib.sha256("".join(map(self.said.__getitem__, (lead * self.size + ids).tolist()))[1:].encode()).hexdigest()

    def groups(self, found: Alignment) -> list[tuple[list[int], list[int]]]:
        """A and B ids of each group."""
        cut_a, cut_b = np.cumsum(found.count_a)[:-1], np.cumsum(found.count_b)[:-1]
        return [(x.tolist(), y.tolist()) for x, y in zip(np.split(found.a, cut_a), np.split(found.b, cut_b), strict=True)]


def _digests(body) -> list:
    return [F.xxhash64(body).alias("h"), F.xxhash64(F.lit(13), body).alias("g")]


def _aligned(texts: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Measures and link pairs of ``(text, copies)``; rows after the first of a text hold further pairs only."""
    held = _held(texts.sparkSession, byte_level, pieces)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*held.value)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                b = whole.slice(at, TEXTS)
                rows: list[tuple] = []
                pairs, often, load = [], [], 0
                for h, g, copies, text in zip(*(b.column(c).to_pylist() for c in ("h", "g", "copies", "text")), strict=True):
                    found = aligner.align(text)
                    if found is None:
                        continue
                    measures = (len(found.a), len(found.b), found.groups, found.links, aligner.digest(found))
                    for k, (pair, times) in enumerate(found.pairs()):
                        rows.append((h, g, copies, *(measures if k == 0 else [None] * 5)))
                        pairs.append(pair)
                        often.append(times)
                        load += len(pair)
                        if load > PAIRS:
                            yield batch(rows, pairs, often)
                            rows, pairs, often, load = [], [], [], 0
                yield batch(rows, pairs, often)

    def batch(rows: list[tuple], pairs: list[np.ndarray], often: list[np.ndarray]) -> pa.RecordBatch:
        ends = pa.array(np.cumsum([0, *map(len, pairs)]).astype(np.int32))
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (pairs, often)]
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in flat]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 8
        kinds = [pa.int64()] * 7 + [pa.string()]
        made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*made, *lists], names=["h", "g", "copies", *numbers, "groups_sha256", "pair", "times"])

    schema = "h long, g long, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<long>, times array<long>"
    return texts.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, count, best)``: documents that hold each pair linked, and whether no pair of its A id has more."""
    counts = written(aligned.select("copies", F.explode("pair").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("count")), "pair-counts")
    first = F.shiftright("pair", 32).alias("a")
    most = written(counts.groupBy(first).agg(F.max("count").alias("most")), "most")
    return attach(counts.withColumn("a", F.shiftright("pair", 32)), most, ["a"]).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Measures of every row, and ``pair_counts`` of the corpus.

    The first has one row per input row: key, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.  Texts that are null, empty or not spelled by the tokens of
    both sides have zeros and an empty digest.  Every row is a document: repeated rows and
    copies count as often as they occur.  Other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    distinct = docs.where(F.length(body) > 0).groupBy(body.alias("text")).agg(F.count("*").alias("copies")).select("copies", "text", *_digests(F.col("text")))
    aligned = written(_aligned(distinct, byte_level, pieces), "aligned")
    counts = written(pair_counts(aligned), "pairs")
    linked = aligned.select("h", "g", F.explode(F.arrays_zip("pair", "times")).alias("x")).select("h", "g", "x.pair", "x.times")
    weighed = attach(linked, counts, ["pair"], "inner")
    sums = weighed.groupBy("h", "g").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    measures = written(aligned.where("n_a is not null").select("h", "g", *numbers, "groups_sha256").join(sums, ["h", "g"]), "measures")
    out = attach(docs.select(F.col(key), *_digests(body)), measures, ["h", "g"])
    return out.select(key, *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in [*numbers, "n_best", "count_sum"]), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), counts


def alignment_measures(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """The measures of ``align_documents`` alone."""
    return align_documents(docs.select("doc_id", "text"), byte_level, pieces)[0]


def aligned_groups(docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, a, b)`` with the id lists of every group in order; rows without tokens have empty lists."""
    held = _held(docs.sparkSession, byte_level, pieces)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*held.value)
        for b in batches:
            found = [aligner.align(t) for t in b.column("text").to_pylist()]
            own = [aligner.groups(x) if x else [] for x in found]
            kind = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array([[g[k] for g in o] for o in own], kind) for k in (0, 1))], names=[key, "a", "b"])

    return rows.mapInArrow(run, f"`{key}` {rows.dtypes[0][1]}, a array<array<int>>, b array<array<int>>")


def _held(spark: SparkSession, byte_level: str, pieces: str):
    """Both tokenizer files for the tasks: a few MB, read where they are installed."""
    return spark.sparkContext.broadcast(tuple(open(p, "rb").read() for p in (byte_level, pieces)))
