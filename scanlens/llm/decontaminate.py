"""Benchmark decontamination with one Aho-Corasick automaton over normalised item windows.

Texts are read as words of lower-cased letters and digits.  Every run of ``window``
consecutive words of an item is a pattern; an item with fewer words is one pattern.
The automaton works on word numbers, scans a text once and reports the last word of
each occurrence; word numbers map back to byte offsets of the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens.llm.common import map_batches, set_aside, texts

#: A word: digits, ASCII letters (lower-cased A-Z) and everything beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
WINDOW = 10
#: UTF-8 bytes of item texts in one automaton; more items are scanned for in several passes.
BLOCK_BYTES = 16 << 20


class Windows:
    """The automaton of some items: ``(item id as text, text)``."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.numbers: dict[str, int] = {}
        held: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in WORD.findall(text.translate(LOWER))]
            for i in range(max(1, len(words) - window + 1)) if words else ():
                held.setdefault(tuple(words[i : i + window]), set()).add(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, owners in held.items():
            self.machine.add_word(words, (len(words), owners))
        self.any = bool(held)
        if self.any:
            self.machine.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged runs ``[first, last)`` of hit words, items that occur."""
        words = WORD.findall(text.translate(LOWER))
        runs: list[tuple[int, int]] = []
        found: set[str] = set()
        if self.any and words:
            number = self.numbers.get
            known = tuple([number(w, 0) for w in words])
            if any(known):
                for last, (n, owners) in self.machine.iter(known):
                    found |= owners
                    first, end = last - n + 1, last + 1
                    while runs and runs[-1][1] >= first:
                        before = runs.pop()
                        first, end = min(first, before[0]), max(end, before[1])
                    runs.append((first, end))
        return len(words), runs, found


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of a bounded number of bytes, one at a time on the driver; each is read by its own small job."""
    rows = items.select(F.col(key).cast("string").alias("item"), F.coalesce(text, F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    count = -(-size // BLOCK_BYTES) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for k in range(count):
        yield [(r.item or "", r.text) for r in rows.where(part == k).toLocalIterator()]


def find_items(docs: DataFrame, items: DataFrame, item_key: str = "item_id", item_text: str = "text", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add what each text holds of the items: n_words, n_hit, hit_spans, found_items.

    ``hit_spans`` are merged character spans of the original text, ``found_items`` the
    sorted distinct item ids as strings.  A null or empty text, and an empty item
    table, give 0 and empty lists.  All other columns pass through; columns with one
    of the four names are replaced.  Items are a stated query set: blocks of bounded
    size, one narrow pass over the documents for each, no shuffle.
    """
    spark = docs.sparkSession
    added = ["n_words", "n_hit", "hit_spans", "found_items"]
    names = [c for c in docs.columns if c not in added]
    docs = docs.select(*names)
    schema = ", ".join(f"`{c}` {k}" for c, k in docs.dtypes) + ", n_words long, n_hit long, hit_spans array<struct<start:int,end:int>>, found_items array<string>"
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for block in _blocks(items, item_key, item_text):
        held = spark.sparkContext.broadcast(block)
        before = "hit_spans" in docs.columns

        def start(held=held, before=before):
            windows = Windows(held.value, window)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                own = texts(batch, text)
                spans, kinds = (batch.column(c).to_pylist() if before else [[] for _ in own] for c in ("hit_spans", "found_items"))
                out = [_merged(t, windows, s, f) for t, s, f in zip(own, spans, kinds, strict=True)]
                new = [pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), span, pa.list_(pa.string())))]
                return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], names=[*names, *added])

            return step

        docs = map_batches(docs, schema, start)
    return docs


def _merged(text: str, windows: Windows, spans: list, items: list) -> tuple[int, int, list[dict], list[str]]:
    """One text against one block, joined with what earlier blocks found."""
    n, runs, found = windows.scan(text)
    if not runs and not spans:
        return n, 0, [], []
    at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    hit = {i for a, b in runs for i in range(a, b)}
    for s in spans:
        hit |= {i for i, (a, b) in enumerate(at) if a >= s["start"] and b <= s["end"]}
    out: list[dict] = []
    last = -2
    for i in sorted(hit):
        if i == last + 1:
            out[-1]["end"] = at[i][1]
        else:
            out.append({"start": at[i][0], "end": at[i][1]})
        last = i
    return n, len(hit), out, sorted({*items, *found})


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans."""
    found = find_items(docs.select(key, "text"), items, **options)
    return found.select(
        key,
        "n_words",
        "n_hit",
        F.size("found_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "hit_spans",
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any occurrence of an item window; columns unchanged.

    Null and empty texts hold none and stay; repeated rows are judged alike.  Extra columns
    pass through, whatever their names.
    """
    rows, restore = set_aside(docs, ["n_words", "n_hit", "hit_spans", "found_items"])
    return restore(find_items(rows, items).where("n_hit = 0"))


def digest_of(items: list[str]) -> str:
    """SHA-256 of sorted, comma-joined item ids, as ``contamination`` gives it."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


#: The same result in SQL.  A document window is looked up for each length that items use.
CONTAMINATION_SQL = r"""
WITH dw AS (
  SELECT rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
ip AS (SELECT item, least(len(w), 10) AS n, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM iw WHERE len(w) > 0),
pat AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM ip),
dp AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw CROSS JOIN (SELECT DISTINCT n FROM pat) WHERE len(w) >= n),
hits AS (SELECT DISTINCT rid, i, dp.n, item FROM (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM dp) dp JOIN pat ON dp.n = pat.n AND dp.k = pat.k),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""
