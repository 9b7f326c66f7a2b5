"""Language identification by Bayesian evidence fusion.

Four sources speak about the language of a text: the likelihood of its byte trigrams
under each language, the language its markup declares, the suffix of its address, and
its host.  Host priors come from one grouped aggregation of the text evidence and are
smoothed towards the suffix, and suffixes towards the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlens.llm.common import attach, set_aside, small_batches
from scanlens.session import written

#: Cells that trigrams are hashed to.
CELLS = 1 << 15
#: Different texts of each declared language that its trigrams are counted in, about (drawn by hash).
FIT_ROWS = 5_000
#: Different texts in the whole corpus that a declared language needs to be modelled.
LEAST_ROWS = 5
#: More declared languages than this are an error: the column holds something else.
MOST_LANGUAGES = 2_000
#: Languages whose counts a task holds before it hands them on.
HELD = 64
#: Neighbouring trigrams repeat each other: weight of their summed log likelihood.
WEIGHT = 0.25
#: Rows that the level above counts for in a smoothed prior.
STRENGTH = 20.0
#: Prior of a text in none of the modelled languages.
OTHER = 1e-3
#: Probability that a declaration is true, if the corpus says nothing about it.
TRUST = 0.9
#: Share of the posterior that the best language needs.
ACCEPT = 0.5
#: Bytes of a text that are counted at a time.
BLOCK = 1 << 16


def cells(text: str) -> Iterator[np.ndarray]:
    """Hashed byte trigrams of the lower-cased text, block by block."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    for s in range(0, len(raw) - 2, BLOCK):
        b = raw[s : s + BLOCK + 2]
        yield ((b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(17)).astype(np.int32)


@dataclass
class Trigrams:
    """Log probability of every cell under each language; the last row is the flat law of no language."""

    languages: list[str]
    table: np.ndarray  # cells x (languages + 1)

    def log_likelihood(self, text: str) -> np.ndarray:
        out = np.zeros(self.table.shape[1])
        for c in cells(text):
            out += self.table[c].sum(0, dtype=np.float64)
        return out * WEIGHT


def declared_languages(labelled: DataFrame) -> dict[str, int]:
    """Different texts of every declared language that has enough of them, over all rows of ``(text, lang)``.

    Copies of a text count once, so a corpus and ten copies of it have the same languages.
    """
    texts = labelled.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.lit(1).alias("one"))
    found = texts.groupBy("lang").agg(F.count("one").alias("n")).where(F.col("n") >= LEAST_ROWS).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} declared languages")
    return {r.lang: r.n for r in found}


def fit(docs: DataFrame, text: str = "text", declared: str = "lang", rows: int = FIT_ROWS) -> Trigrams:
    """Trigram model of every declared language with ``LEAST_ROWS`` different texts.

    Each language is counted in about ``rows`` different texts of its own, drawn by hash;
    the draw and the list of languages do not depend on partitions or copies.
    """
    labelled = docs.select(F.col(text).alias("text"), F.lower(F.trim(declared)).alias("lang")).where("text is not null and lang <> ''")
    sizes = declared_languages(labelled)
    languages = sorted(sizes)
    table = np.ones((CELLS, len(languages) + 1))
    if languages:
        shares = [(lang, max(1, int(min(1.0, rows / n) * (1 << 20)))) for lang, n in sizes.items()]
        chosen = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share long"))
        drawn = labelled.join(chosen, "lang").where(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 20)) < F.col("share"))
        drawn = drawn.select("text", "lang").distinct()
        counted = drawn.mapInArrow(_counted, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
        at = {lang: i for i, lang in enumerate(languages)}
        for b in counted.toArrow().to_batches():  # at most CELLS rows a language
            where = np.array([at[x] for x in b.column("lang").to_pylist()], np.int64)
            table[b.column("cell").to_numpy(), where] += b.column("n").to_numpy()
    return Trigrams(languages, np.log(table / table.sum(0)).astype(np.float32))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams by language and cell; counts of many languages leave the task in parts."""
    held: dict[str, np.ndarray] = {}

    def parts() -> Iterator[pa.RecordBatch]:
        for lang, n in held.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(n[used])], names=["lang", "cell", "n"])
        held.clear()

    for b in batches:
        for t, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
            if lang not in held:
                if len(held) >= HELD:
                    yield from parts()
                held[lang] = np.zeros(CELLS, np.int64)
            for c in cells(t):
                held[lang] += np.bincount(c, minlength=CELLS)
    yield from parts()


def evidence(docs: DataFrame, model: Trigrams, text: str = "text") -> DataFrame:
    """Add ``__ll`` (log likelihoods) and ``__p`` (posterior of the text alone) to every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    k = len(model.languages)
    flat = np.log(np.array([*[(1 - OTHER) / max(1, k)] * k, OTHER]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ll = np.array([held.value.log_likelihood(t or "") for t in b.column(text).to_pylist()]).reshape(-1, k + 1)
            p = np.exp(ll + flat - (ll + flat).max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            new = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), k + 1).cast(pa.list_(pa.float64())) for x in (ll - ll.max(1, keepdims=True), p)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, "__ll", "__p"])

    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{fields}, __ll array<double>, __p array<double>")


def _sums(k: int) -> Column:
    return F.array(*(F.sum(F.col("__p")[i]) for i in range(k)))


def _smoothed(own: Column, above: Column) -> Column:
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(own, above, lambda n, p: (n + STRENGTH * p) / (total + STRENGTH))


def priors(rows: DataFrame, model: Trigrams) -> tuple[DataFrame, list[list[float]]]:
    """Host priors ``(__host, __suffix, __prior)``, and the law of declarations.

    ``rows`` have ``__host, __suffix, __declared, __p``.  Counts are sums of posteriors
    over all rows.  The law holds, for each declared language (then: another one), its
    probability under each language.
    """
    k = len(model.languages) + 1
    hosts = written(rows.groupBy("__host", "__suffix").agg(_sums(k).alias("n")), "hosts")
    add = F.array(*(F.sum(F.col("n")[i]) for i in range(k)))
    whole = (hosts.agg(add.alias("n")).first() or [None])[0] or [0.0] * k
    whole = [x or 0.0 for x in whole]
    base = [(n + 1.0 / k) / (sum(whole) + 1.0) for n in whole]
    suffixes = hosts.groupBy("__suffix").agg(add.alias("above")).select("__suffix", _smoothed(F.col("above"), F.array(*(F.lit(x) for x in base))).alias("above"))
    table = written(attach(hosts, written(suffixes, "suffixes"), ["__suffix"]).select("__host", "__suffix", _smoothed(F.col("n"), F.col("above")).alias("__prior")), "priors")
    said = F.coalesce(F.array_position(F.array(*(F.lit(x) for x in [*model.languages, ""])), F.col("__declared")), F.lit(0))
    law = np.zeros((k, k))
    for r in rows.where("__declared is not null").groupBy(said.alias("d")).agg(_sums(k).alias("n")).collect():
        law[(r.d - 1) if r.d else k - 1] += np.array(r.n)
    for i in range(k):
        prior = np.full(k, (1 - TRUST) / max(1, k - 1))
        prior[i] = TRUST
        law[:, i] = (law[:, i] + STRENGTH * prior) / (law[:, i].sum() + STRENGTH)
    return table, law.tolist()


def fused(rows: DataFrame, model: Trigrams, table: DataFrame, law: list[list[float]]) -> DataFrame:
    """Add ``language``, ``confidence``, ``accepted`` to rows with evidence."""
    k = len(model.languages) + 1
    names = F.array(*(F.lit(x) for x in [*model.languages, "und"]))
    laws = F.array(*(F.array(*(F.lit(float(np.log(x))) for x in row)) for row in law))
    at = F.coalesce(F.array_position(names, F.col("__declared")), F.lit(0)).cast("int")
    row = F.when(F.col("__declared").isNull(), F.array_repeat(F.lit(0.0), k)).otherwise(F.element_at(laws, F.when(at > 0, at).otherwise(k)))
    joined = attach(rows, table, ["__host", "__suffix"])
    prior = F.transform("__prior", lambda x: F.log(x))
    joined = joined.withColumn("__s", F.zip_with(F.zip_with("__ll", prior, lambda a, b: a + b), row, lambda a, b: a + b))
    best = F.array_max("__s")
    mass = F.aggregate("__s", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("__s")))
    out = joined.withColumn("language", F.element_at(names, F.array_position("__s", best).cast("int"))).withColumn("confidence", 1 / mass)
    return out.withColumn("accepted", (F.col("language") != "und") & (F.col("confidence") >= ACCEPT))


def _marked(docs: DataFrame, declared: Column | None, host: Column | None, suffix: Column | None) -> DataFrame:
    void = F.lit(None).cast("string")
    clean = F.lower(F.trim(declared)) if declared is not None else void
    return docs.withColumns(
        {
            "__declared": F.when(clean != "", clean),
            "__host": F.coalesce(F.lower(host) if host is not None else void, F.lit("")),
            "__suffix": F.coalesce(F.lower(suffix) if suffix is not None else void, F.lit("")),
        }
    )


def identify(docs: DataFrame, keep: list[str], text: str = "text", declared: Column | None = None, host: Column | None = None, suffix: Column | None = None, model: Trigrams | None = None) -> DataFrame:
    """One row per input row: the columns ``keep``, language, confidence, accepted.

    ``declared``, ``host`` and ``suffix`` are column expressions; each may be missing or
    null, which is no evidence (rows without a host share one prior).  Without ``model``
    the trigrams are fitted on the declared languages.  A null or empty text leaves the
    word to the other evidence.  ``und`` is a text in none of the languages; it and
    texts below the confidence ``ACCEPT`` are not accepted.  Columns of ``keep`` named
    like an added one are replaced.
    """
    marked = _marked(small_batches(docs), declared, host, suffix).withColumn("__text", F.col(text))
    model = model or fit(marked, "__text", "__declared")
    keep = [c for c in keep if c not in ("language", "confidence", "accepted")]
    narrow = marked.select(*keep, "__text", "__declared", "__host", "__suffix")
    if text in keep:  # wide rows are read twice instead of being written
        rows = evidence(narrow, model, "__text").drop("__text")
        table, law = priors(evidence(narrow.select("__text", "__declared", "__host", "__suffix"), model, "__text").drop("__text"), model)
    else:
        rows = written(evidence(narrow, model, "__text").drop("__text"), "evidence")
        table, law = priors(rows, model)
    return fused(rows, model, table, law).select(*keep, "language", "confidence", "accepted")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The documents in a modelled language; columns unchanged.

    Null and empty texts are judged by their declaration and source alone.  Repeated rows are
    judged alike; extra columns pass through, whatever their names.
    """
    rows, restore = set_aside(docs, ["language", "confidence", "accepted"])
    return restore(identify(rows, rows.columns, declared=F.col("lang"), host=F.col("source")).where("accepted"))
