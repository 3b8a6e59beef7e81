"""Language identification by Bayesian fusion of text, markup and address evidence.

For a row with text t, declared language d, host h with address suffix s:

    P(l | t, d, h)  ~  P(t | l)**TEMPER * P(d | l) * P(l | h)

* ``P(t | l)``: hashed byte trigrams around the letters of the whole text in lower case,
  fitted on a bounded sample of labelled rows (``train_rows`` per language, drawn by a
  hash of the row's text).  ``und`` is a language in which every trigram
  is equally likely; it wins for text in none of the languages.  Trigrams of
  one text are far from independent, hence the tempering.
* ``P(d | l)``: how often text of language l carries declaration d.
* ``P(l | h)``: the host's languages, smoothed towards those of its address
  suffix, which are smoothed towards those of the corpus.

The last two are counted over all rows by grouped aggregation of the text's
own posterior.  A row is accepted if its best language is not ``und`` and
has at least ``min_posterior``.

Scale: one pass scores the texts and stores the scores beside the columns that are
carried on, so no text is scored twice; counts read only the narrow columns of that table and are
combined on the map side.  The host table grows with the
hosts: it is joined as a stored table, so the planner broadcasts it only while
its real size is small and else shuffles, splitting a hot host.

A language with too little labelled text to be modelled (``MIN_CHARS``) cannot be told from its text.  A text in none of the
modelled languages that declares such a language is taken at its word and accepted, so no row is
lost because its language is rare.

Defined cases: a NULL, empty or blank text is in no language and is rejected; a text without letters is
judged by declaration and host; a NULL declaration or host counts as a value
of its own; without any modelled language every text that declares one is in that, and the others are ``und`` and rejected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import hash32, lean_steps, stored

UNKNOWN = "und"
BUCKETS = 1 << 16
#: labelled rows per language that the text model is fitted on (about; drawn by hash)
TRAIN_ROWS = 2_000
#: weight of one trigram
TEMPER = 0.2
#: a language needs this many characters of distinct labelled texts to be modelled, however common others are
MIN_CHARS = 1_000
#: share of a language's probability that is spread evenly over all trigrams (names, codes, typing errors)
EVEN = 0.05
#: strength of the smoothing of host and suffix
STRENGTH = 20.0
UNKNOWN_PRIOR = 1e-4
#: rows and bytes (one row at least) that Python gets at once
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
#: digits, punctuation and white space say nothing about the language
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _trigrams(text: str | None) -> np.ndarray:
    """Hashed buckets of the byte trigrams around each letter byte."""
    plain = (text or "").lower().encode("utf-8", "replace").translate(_LETTERS)
    b = np.frombuffer(b" " + plain + b" ", np.uint8).astype(np.uint32)
    ids = (((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)
    return ids[b[1:-1] != 32]


class TextModel:
    """Log-probabilities of trigram buckets, one row per language and a last one for ``und``."""

    def __init__(self, languages: Sequence[str], counts: np.ndarray):
        self.languages = [*languages, UNKNOWN]
        shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        logs = np.log((1 - EVEN) * shares + EVEN / BUCKETS)
        self.logs = np.vstack([logs, np.full((1, BUCKETS), -math.log(BUCKETS))]).T.astype(np.float32).copy()


def _score(logs: np.ndarray, text: str | None) -> list[float]:
    total = np.zeros(logs.shape[1])
    ids = _trigrams(text)
    for i in range(0, len(ids), 1 << 16):  # a bounded slice of a long text at a time
        total += logs[ids[i:i + (1 << 16)]].sum(axis=0, dtype=np.float64)
    return (TEMPER * total).tolist()


def fit_text_model(rows: DataFrame, text: Column, label: Column, train_rows: int = TRAIN_ROWS) -> TextModel:
    """Fitted on about ``train_rows`` rows of each language with at least ``MIN_CHARS`` of labelled text."""
    rows = rows.select(text.cast("string").alias("text"), _declaration(label).alias("label")).filter(
        "label is not null and label <> ''")
    texts = rows.groupBy("label", F.md5("text").alias("digest")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length("text")).alias("chars"))
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))
             .filter(F.col("chars") >= MIN_CHARS).collect()}
    languages = sorted(sizes)
    if not languages:
        return TextModel([], np.zeros((0, BUCKETS)))
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, train_rows / sizes[k])))])
    sample = rows.filter(F.col("label").isin(languages)).filter(
        hash32("text") < share[F.col("label")] * F.lit(float(1 << 32)))

    def count(batches):
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for frame in batches:
            for name, text in zip(frame["label"], frame["text"]):
                total[languages.index(name)] += np.bincount(_trigrams(text), minlength=BUCKETS)
        which, bucket = np.nonzero(total)
        yield pd.DataFrame({"which": which, "bucket": bucket, "n": total[which, bucket]})

    with lean_steps(rows.sparkSession, BATCH_ROWS, BATCH_BYTES):
        sums = (sample.mapInPandas(count, "which int, bucket int, n long")
                .groupBy("which", "bucket").agg(F.sum("n").alias("n")).toPandas())  # languages x BUCKETS at most
    counts = np.zeros((len(languages), BUCKETS))
    counts[sums["which"], sums["bucket"]] = sums["n"]
    return TextModel(languages, counts)


def _declaration(label: Column) -> Column:
    """``en-GB`` and ``EN`` are both ``en``."""
    return F.lower(F.substring_index(label.cast("string"), "-", 1))


def _scorer(rows: DataFrame, model: TextModel):
    shared = rows.sparkSession.sparkContext.broadcast(model.logs)  # languages x BUCKETS floats

    @F.pandas_udf("array<double>")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([_score(shared.value, t) for t in texts])

    return score


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    parts = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(parts, lambda x: x / F.aggregate(parts, F.lit(0.0), lambda a, b: a + b))


def address_suffix(host: Column) -> Column:
    """The last label of a host name; empty if it has no dot."""
    return F.when(host.contains("."), F.lower(F.substring_index(host, ".", -1))).otherwise(F.lit(""))


def identify(rows: DataFrame, text: Column, declared: Column, host: Column, model: TextModel,
             min_posterior: float = 0.5, carry: Sequence[str] | None = None) -> DataFrame:
    """``rows`` plus ``detected``, ``posterior``, ``text_language`` and ``accepted`` (columns of those names are replaced).

    ``carry`` names the columns of ``rows`` that come back (default: all).  They are stored once with the
    scores of the text, which is so scored only once.
    """
    n = len(model.languages)
    names = F.array(*[F.lit(x) for x in model.languages])
    score = _scorer(rows, model)
    known = {"__declared": F.coalesce(_declaration(declared), F.lit("\x00")),
             "__host": F.coalesce(host.cast("string"), F.lit("\x00"))}
    no_text = F.coalesce(F.trim(F.translate(text.cast("string"), "\t\n\x0b\x0c\r", "     ")), F.lit("")) == ""
    kept = [c for c in (rows.columns if carry is None else carry)
            if c not in ("detected", "posterior", "text_language", "accepted")]
    marked = rows.withColumns({**known, "__suffix": F.coalesce(address_suffix(host.cast("string")), F.lit("\x00")),
                               "__said": F.nullif(_declaration(declared), F.lit("")), "__no_text": no_text,
                               "__logs": score(text.cast("string"))})
    marked = marked.select(*[F.col(f"`{c}`") for c in kept], "__declared", "__host", "__suffix", "__said",
                           "__no_text", "__logs")
    with lean_steps(rows.sparkSession, BATCH_ROWS, BATCH_BYTES):
        marked = stored(marked, "language-scores")
    flat = F.array(*[F.lit(math.log((1 - UNKNOWN_PRIOR) / max(1, n - 1)))] * (n - 1) + [F.lit(math.log(UNKNOWN_PRIOR))])
    narrow = marked.select("__declared", "__host", "__suffix",
                           _softmax(F.zip_with("__logs", flat, lambda a, b: a + b)).alias("__p"))

    # --- grouped counts of the text's posterior -----------------------------
    sums = [F.sum(F.col("__p")[i]).alias(f"n{i}") for i in range(n)]
    as_array = lambda: F.array(*[F.col(f"n{i}") for i in range(n)])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    by_host = stored(narrow.groupBy("__host", "__suffix").agg(*sums), "host-counts")
    by_suffix = by_host.groupBy("__suffix").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(n)])
    corpus = by_host.agg(*[F.sum(f"n{i}") for i in range(n)]).first()
    size = sum(x or 0.0 for x in corpus)
    base = [((x or 0.0) + 1.0) / (size + n) for x in corpus]
    base_array = F.array(*[F.lit(b) for b in base])
    smooth = lambda counts, prior: F.zip_with(
        counts, prior, lambda c, p: (c + STRENGTH * p) / (total(counts) + STRENGTH))
    by_suffix = by_suffix.select(F.col("__suffix").alias("__s"), smooth(as_array(), base_array).alias("__sp"))
    prior = stored(by_host.join(by_suffix, F.col("__suffix") == F.col("__s"))
                   .select(F.col("__host").alias("__h"), F.col("__suffix").alias("__hs"),
                           F.transform(smooth(as_array(), F.col("__sp")), lambda p: F.log(p)).alias("__prior")),
                   "host-priors")
    by_declared = narrow.groupBy("__declared").agg(*sums)
    kinds = by_declared.count()
    likely = stored(by_declared.select(
        F.col("__declared").alias("__d"),
        F.array(*[F.log((F.col(f"n{i}") + 1.0) / ((corpus[i] or 0.0) + max(1, kinds))) for i in range(n)])
        .alias("__declares")), "declared-likelihoods")

    # --- fusion ---------------------------------------------------------------
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = (marked.join(prior, (F.col("__host") == F.col("__h")) & (F.col("__suffix") == F.col("__hs")))
             .join(likely, F.col("__declared") == F.col("__d"))
             .withColumn("__post", _softmax(add(F.col("__logs"), add(F.col("__prior"), F.col("__declares"))))))
    no_text, said = F.col("__no_text"), F.col("__said")
    unmodelled = said.isNotNull() & ~said.isin(model.languages)
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    fused = fused.withColumns({
        "__best": F.when(no_text, F.lit(UNKNOWN)).otherwise(best(F.col("__post"))),
        "__text": F.when(no_text, F.lit(UNKNOWN)).otherwise(best(F.col("__logs"))),
        "__top": F.array_max("__post")})
    # in no modelled language, and declares one that has no model
    fused = fused.withColumn("__trusted", unmodelled & ~no_text & (F.col("__best") == UNKNOWN))
    fused = fused.withColumn("__best", F.when(F.col("__trusted"), said).otherwise(F.col("__best")))
    return (fused
            .withColumns({"detected": F.col("__best"), "posterior": F.round("__top", 9),
                          "text_language": F.col("__text"),
                          "accepted": F.col("__trusted") | (F.col("__best") != UNKNOWN) & (F.col("__top") >= min_posterior)})
            .drop("__declared", "__host", "__suffix", "__said", "__no_text", "__logs", "__h", "__hs", "__prior", "__d", "__declares",
                  "__post", "__best", "__text", "__top", "__trusted"))


def documents_in_known_languages(docs: DataFrame, text_col: str = "text", declared_col: str = "lang",
                                 host_col: str = "source") -> DataFrame:
    """The accepted rows of ``docs`` with their columns."""
    cols = docs.columns
    text, declared, host = (F.col(f"`{c}`") for c in (text_col, declared_col, host_col))
    model = fit_text_model(docs, text, declared)
    # the verdict's columns must not displace the table's own
    wrapped = docs.select(text.alias("__t"), declared.alias("__l"), host.alias("__src"), F.struct(*[
        F.col(f"`{c}`") for c in cols]).alias("__row"))
    judged = identify(wrapped, F.col("__t"), F.col("__l"), F.col("__src"), model, carry=["__row"])
    return judged.filter("accepted").select("__row.*")
