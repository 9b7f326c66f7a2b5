"""Line dedup: a line that an earlier document holds goes, and only bitmaps tell which.

Lines travel as 128-bit hashes of their keys with document and position, never as text.
They are range-partitioned by hash and sorted by document and position, so that the first
occurrence of a key heads its stretch and the rest streams past it.  What is dropped
comes back as one compressed bitmap per document: 64 lines a word, only words with a
dropped line.  DataFrame functions only.

A key with more than one row in ``HOT_PARTS`` would fill a partition of its own.  Such
keys, at most ``HOT_PARTS``, get their first document by an aggregate that combines before
the exchange, and their rows are marked where they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlens.llm.common import BROADCAST_BYTES, table_bytes
from scanlens.session import written

#: Code points that a key needs at least; shorter lines always stay.
LEAST_CHARS = 10
#: Stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: A key is hot with more rows than this, and more than one in HOT_PARTS of all.
HOT_ROWS, HOT_PARTS = 1_000, 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line stripped of ``BLANKS``, A-Z in lower case; ``lower`` does just that to ASCII."""
    bare = F.trim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _lines(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """``(late, id, print, pos, h, g)`` of every line whose key is long enough."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).isNull().alias("late"), F.col(key).alias("id"), F.xxhash64(body).alias("print"), F.posexplode(F.split(body, "\n")).alias("pos", "line"))
    rows = rows.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= least)
    return rows.select("late", "id", "print", "pos", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(11), "key").alias("g"))


def _hot(lines: DataFrame) -> DataFrame | None:
    """``(h, g, first)`` of the keys with very many rows, or None; at most HOT_PARTS rows.

    Counts of 65,536 cells of hashes find where such keys can be, an exact count over those
    cells which they are.  Both combine before they shuffle.
    """
    cell = F.shiftrightunsigned("h", 48).cast("int")
    cells = lines.groupBy(cell.alias("cell")).count()
    total = cells.agg(F.sum("count")).first()[0] or 0
    least = max(HOT_ROWS, total // HOT_PARTS)
    full = [r.cell for r in cells.where(F.col("count") > least).collect()]
    if not full:
        return None
    counted = lines.where(cell.isin(full)).groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct("late", "id")).alias("first"))
    return written(counted.where(F.col("n") > least).select("h", "g", "first"), "hot-lines")


def _dropped(lines: DataFrame) -> DataFrame:
    """``(late, id, print, pos)`` of the lines whose key a smaller document holds."""
    hot = _hot(lines)
    place = ["late", "id", "print", "pos"]
    cold = lines if hot is None else lines.join(F.broadcast(hot.select("h", "g")), ["h", "g"], "left_anti")
    order = Window.partitionBy("h", "g").orderBy(*place)
    marked = cold.repartitionByRange("h", "g").withColumn("first", F.first(F.struct("late", "id")).over(order))
    out = marked.where(~F.col("id").eqNullSafe(F.col("first.id"))).select(*place)
    if hot is None:
        return out
    again = lines.join(F.broadcast(hot), ["h", "g"]).where(~F.col("id").eqNullSafe(F.col("first.id")))
    return out.union(again.select(*place))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """``(id, print, keep)`` of every document that loses a line.

    ``print`` is a hash of the text: rows of one id with different texts are told apart.
    ``keep`` lists, in order, the words of 64 lines in which a line is dropped; a set bit
    is a line that stays, and words not listed are all ones.
    """
    lines = written(_lines(docs, key, text, least), "lines")
    word = F.floor(F.col("pos") / 64).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = _dropped(lines).groupBy("id", "print", word).agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
    return words.groupBy("id", "print").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def _kept(lines: Column, keep: Column) -> Column:
    """The lines whose bit is set; the words left out are put back as ones."""
    gap = lambda w, k: w["word"] - F.when(k > 0, F.get(keep, k - 1)["word"]).otherwise(-1) - 1
    dense = F.flatten(F.transform(keep, lambda w, k: F.concat(F.array_repeat(F.lit(-1).cast("long"), gap(w, k)), F.array(w["bits"]))))
    stays = lambda d, i: F.expr("1L") == F.coalesce(F.call_function("getbit", F.get(d, F.floor(i / 64).cast("int")), F.pmod(i, F.lit(64))).cast("long"), F.expr("1L"))
    # an array of one binds the bits once for all lines
    return F.get(F.transform(F.array(dense), lambda d: F.filter(lines, lambda _, i: stays(d, i))), F.lit(0))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """Add ``n_lines``, ``n_dropped``, ``keep``, ``kept_text`` to every row; other columns pass through.

    Columns of these names are replaced.  A null or empty text is one empty line.  Rows
    of one id are one document, whatever their texts, and so are all rows without an
    id, which come after all others.  Repeated rows get equal results.  ``keep`` is null
    where nothing is dropped; a text that loses all its lines is the empty text.
    """
    added = ["n_lines", "n_dropped", "keep", "kept_text"]
    names = [c for c in docs.columns if c not in added]
    body = F.coalesce(F.col(text), F.lit(""))
    found = written(keep_bitmaps(docs.select(key, text), key, text, least), "bitmaps").select(F.col("id").alias("__id"), F.col("print").alias("__print"), F.col("keep").alias("__keep"))
    if table_bytes(found) + 16 * (found.agg(F.sum(F.size("__keep"))).first()[0] or 0) <= BROADCAST_BYTES:
        found = F.broadcast(found)
    mine = docs.select(*names, F.xxhash64(body).alias("__own"))
    joined = mine.join(found, (F.col("__own") == F.col("__print")) & F.col(key).eqNullSafe(F.col("__id")), "left")
    keep = F.col("__keep")
    lines = F.split(body, "\n")
    gone = F.aggregate(keep, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(F.bitwise_not(w["bits"])))
    kept = F.when(keep.isNull(), body).otherwise(F.array_join(_kept(lines, keep), "\n"))
    return joined.select(*names, F.size(lines).cast("long").alias("n_lines"), F.coalesce(gone, F.lit(0)).alias("n_dropped"), keep.alias("keep"), kept.alias("kept_text"))


def line_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_lines, n_dropped, kept_sha256."""
    out = dedup_lines(docs.select(key, text), key, text)
    return out.select(key, "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: The same rows in SQL.
LINES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT rid, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM d),
k AS (SELECT rid, doc_id, i, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM x),
f AS (SELECT key, min(doc_id) AS low FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, coalesce(f.low <> k.doc_id, false) AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
