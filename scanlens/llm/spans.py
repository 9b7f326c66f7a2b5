"""Substring dedup by sliding sentence spans.

A text is cut into sentences, and sentences of more than ``PIECE`` words into pieces at
places that their own words choose.  From every piece the shortest row of pieces with
``RUN_WORDS`` words is hashed, with the rest of its last sentence if that is no more
than a piece.  These runs are counted over all documents; what lies
inside any occurrence of a repeated run but the first is removed.  The first occurrence
is the one with the smallest document id, then the earliest in the text.

Pieces depend on the words around them only, so a passage that is cut inside its
sentences has the same pieces in both places but for ``PIECE`` words at each end.  As
``3 * PIECE + RUN_WORDS`` is about 50, no 50 words in a row stay in two places.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens.llm.common import joined, set_aside, small_batches, stretch_hashes, word_hashes
from scanlens.llm.setjoin import _cells, _marked, _slices
from scanlens.session import written

#: A sentence ends after its full stops and the blanks that follow, or after a line break.
BREAK = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])\s*|\s*\n\s*")
#: Words a run has at least.  Shorter repeats (a licence line, a greeting) are left alone.
RUN_WORDS = 25
#: Longer sentences are cut; no piece has more words.
PIECE = 9
#: Scripts written without blanks: every character is a word.
_SOLO = "฀-໿က-႟ក-៿、-ヿ㐀-䶿一-鿿豈-﫿！？\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_SOLO}]|[^\s{_SOLO}]+")
#: Longer stretches without blanks are cut where their own last characters say so.
LONG = 64


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences, each with the blanks behind it; together they are the text."""
    cuts = [0, *(m.end() for m in BREAK.finditer(text)), len(text)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def _parts(word: str) -> list[int]:
    """Ends of the parts of a stretch without blanks."""
    if len(word) <= LONG:
        return [len(word)]
    ends = [k for k in range(4, len(word)) if xxhash.xxh3_64_intdigest(word[k - 4 : k]) % 16 == 0]
    return [*ends, len(word)]


def word_spans(text: str) -> list[tuple[int, int]]:
    """Spans of the words."""
    out = []
    for m in _WORD.finditer(text):
        a = m.start()
        for e in _parts(m[0]):
            out.append((a, m.start() + e))
            a = m.start() + e
    return out


#: Texts with these take the plain way to their words: scripts without blanks, blanks beyond ASCII.
_ODD = re.compile(rf"[{_SOLO}\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True


def word_table(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in lower case, and the first words of the sentences.

    Words and sentences are those of ``word_spans`` and ``sentences`` (without sentences
    that hold no word).
    """
    none = np.zeros(0, np.int64)
    if not text:
        return none.astype(np.uint64), none
    if text.isascii() or not _ODD.search(text):
        raw = np.frombuffer(text.lower().encode(), np.uint8)
        blank = _BLANK[raw]
        edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        begin, end = edge[::2], edge[1::2]
        if not len(begin):
            return none.astype(np.uint64), none
        if (end - begin).max() <= LONG:
            lines = np.cumsum(raw == 10)
            opens = _STOP[raw[end[:-1] - 1]] | (lines[begin[1:]] > lines[end[:-1] - 1])
            return word_hashes(raw, begin, end), np.flatnonzero(np.append(True, opens))
    words, starts = [], []
    for a, b in sentences(text):
        own = [text[x + a : y + a].lower().encode() for x, y in word_spans(text[a:b])]
        if own:
            starts.append(len(words))
            words += own
    if not words:
        return none.astype(np.uint64), none
    end = np.cumsum([len(w) for w in words])
    return word_hashes(np.frombuffer(b"".join(words), np.uint8), np.append(0, end[:-1]), end), np.array(starts)


def _windowed(f: np.ufunc, x: np.ndarray) -> np.ndarray:
    """Minimum or maximum of every ``PIECE`` neighbours, by doubling."""
    size = 1
    n = len(x) - PIECE + 1
    while 2 * size <= PIECE:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[:n], x[PIECE - size : PIECE - size + n])


def piece_starts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """First words of the pieces, given hashes of the words and the first words of the sentences.

    Of any ``PIECE`` neighbouring places the one whose two words have the smallest hash
    is a cut, if it lies in a sentence of more than ``PIECE`` words.
    """
    n = len(hashes)
    first = np.zeros(n, bool)
    first[starts] = True
    if n > PIECE:
        pair = joined(hashes, np.append(hashes[1:], np.uint64(0)))
        least = _windowed(np.minimum, pair)
        edge = np.zeros(PIECE - 1, np.uint64)
        taken = _windowed(np.maximum, np.concatenate([edge, least, edge])) == pair
        sizes = np.diff(np.append(starts, n))
        first |= taken & np.repeat(sizes > PIECE, sizes)
    return np.flatnonzero(first)


def runs(text: str, least: int = RUN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word after the last, and hash of the run from each piece.

    Hashes ignore case and the width of blanks.
    """
    h, starts = word_table(text)
    n = len(h)
    if n < least:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    first = piece_starts(h, starts)
    edges = np.append(first, n)
    at = np.searchsorted(edges, first + least)
    first = first[at < len(edges)]
    end = edges[at[at < len(edges)]]
    stops = np.append(starts, n)  # a run that ends shortly before its sentence does goes to the end of it
    stop = stops[np.searchsorted(stops, end)]
    end = np.where(stop - end <= PIECE, stop, end)
    return first, end, stretch_hashes(h, first, end)


def _run_rows(docs: DataFrame, least: int, cells: np.ndarray | None = None) -> DataFrame:
    """Hashes of all runs; with a bitmap of cells, the runs in marked cells with their places."""
    held = None if cells is None else docs.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, 250):
            found = [runs(t or "", least) for t in b.column("text").to_pylist()]
            first, end, h = (np.concatenate([f[k] for f in found]) for k in range(3))
            if held is None:
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["run"])
                continue
            row, keep = np.repeat(np.arange(len(found)), [len(f[0]) for f in found]), _marked(held.value, h)
            row = pa.array(row[keep])
            columns = [pa.array(h[keep].view(np.int64)), b.column("id").take(row), b.column("print").take(row), pa.array(first[keep].astype(np.int32)), pa.array(end[keep].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["run", "id", "print", "first", "last"])

    places = "" if cells is None else f", id {dict(docs.dtypes)['id']}, print long, first int, last int"
    return docs.mapInArrow(run, f"run long{places}")


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = RUN_WORDS) -> DataFrame:
    """``(id, print, cut)`` for the documents that lose something; ``cut`` lists ranges of words.

    ``print`` is a hash of the text: rows with equal id and text are one document.  Hashes
    of runs travel alone first; a bitmap of the repeated ones (8 MB) lets few others
    send their places.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("id"), F.xxhash64(body).alias("print"), body.alias("text"))
    often = written(_run_rows(base, least).groupBy("run").count().where("count > 1").select(F.col("run").alias("token")), "often")
    halves = often.select(F.shiftright("token", 32).cast("int").alias("key"))  # with the sign, so that it fits
    near = written(_run_rows(base, least, _cells(halves)), "near")
    place = F.struct(F.col("id").isNull().alias("late"), "id", "print", "first")
    # repeated rows count as well; they are their own first place and drop out below
    repeated = near.groupBy("run").agg(F.min(F.struct(place.alias("at"), F.col("last"))).alias("low"), F.count("*").alias("n"))
    # written, so that the join has an exchange of its own, which the engine can split where one run is everywhere
    repeated = written(repeated.where("n > 1").select("run", F.col("low.at").alias("low"), F.col("low.last").alias("low_last")), "repeated")
    later = near.join(repeated, "run").where(place != F.col("low"))
    # a run that overlaps its own first place (a text that repeats a few words) leaves that place whole
    own = F.col("id").eqNullSafe(F.col("low.id")) & (F.col("print") == F.col("low.print"))
    later = later.withColumn("first", F.when(own, F.greatest("first", "low_last")).otherwise(F.col("first")))
    return later.groupBy("id", "print").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("cut"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = RUN_WORDS) -> DataFrame:
    """Add ``n_sentences``, ``n_removed``, ``kept_text`` to every row; other columns pass through.

    Columns of these names are replaced.  A null text has no sentences and stays null;
    sentences that hold no word do not count.
    Rows with equal id and text count as one document, so neither is the other's repeat;
    rows of one id with different texts are told apart.  A null id comes after all
    others.  A run that repeats inside one document is removed there as well.
    ``n_removed`` counts the sentences that lost words.
    """
    added = ["n_sentences", "n_removed", "kept_text"]
    names = [c for c in docs.columns if c not in added]
    docs = small_batches(docs).select(*names)
    cuts = written(removals(docs, key, text, least), "cuts").select(F.col("id").alias("__id"), F.col("print").alias("__print"), F.col("cut").alias("__cut"))
    mine = docs.withColumn("__own", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = mine.join(cuts, F.col("__own").eqNullSafe(F.col("__print")) & F.col(key).eqNullSafe(F.col("__id")), "left").select(*names, "__cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            out = [_kept(t, c) for t, c in zip(b.column(text).to_pylist(), b.column("__cut").to_pylist(), strict=True)]
            n, gone, kept = zip(*out, strict=True)
            new = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *new], names=[*names, *added])

    fields = ", ".join(f"`{c}` {k}" for c, k in docs.dtypes)
    return joined.mapInArrow(run, f"{fields}, n_sentences long, n_removed long, kept_text string")


def _kept(text: str | None, cut: list[dict] | None) -> tuple[int, int, str | None]:
    """Sentences, sentences that lose words, and the text without the cut ranges of words."""
    starts = word_table(text or "")[1]
    if not cut:
        return len(starts), 0, text
    ranges: list[list[int]] = []
    for c in cut:  # in order of their first words
        if ranges and c["first"] <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], c["last"])
        else:
            ranges.append([c["first"], c["last"]])
    spans = word_spans(text)
    sentence = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(spans))))
    gone = np.zeros(len(spans), bool)
    parts, at = [], 0
    for first, last in ranges:
        gone[first:last] = True
        start, stop = spans[first][0], len(text) if last == len(spans) else spans[last][0]
        edge = int(np.searchsorted(sentence, sentence[first], side="right"))
        if edge <= last and first and sentence[first - 1] == sentence[first]:
            # words go with the blanks behind them; a sentence that loses its end keeps the blanks that close it
            bare, close = text[at:start].rstrip(), text[spans[edge - 1][1] : spans[edge][0] if edge < len(spans) else len(text)]
            parts += [bare, close or text[at + len(bare) : start]]
        else:
            parts.append(text[at:start])
        at = stop
    parts.append(text[at:])
    kept = "".join(parts)
    return len(starts), len(np.unique(sentence[gone])), kept.rstrip() if gone[-1] else kept


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents with repeated sentences removed and ``n_chars`` counted anew; emptied ones go.

    Other columns are unchanged, whatever their names.  Null and empty texts stay.
    """
    rows, restore = set_aside(docs, ["n_sentences", "n_removed", "kept_text"])
    found = remove_repeats(rows)
    kept = found.where("n_removed = 0 or length(trim(kept_text)) > 0").withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return restore(kept)
