"""Quality rules: base counts, then robust outliers per language and source.

Documents that pass the base rules become vectors of transformed statistics.
For each language and source a minimum-covariance-determinant estimate is fitted
over all of them. It starts from four estimates (median and MAD, spatial signs,
hyperbolic tangents, plain moments); from each, concentration steps keep the
half nearest by Mahalanobis distance until the determinant falls no more. The
start that ends with the smallest determinant counts, and one reweighting step
takes everything within its 97.5 % ellipsoid. A vector whose distance to the
final estimate is beyond the ``REJECT`` quantile is rejected.

A statistic that is the same in half of a group (no symbols, say) has no spread
there, and its determinant is zero. Every covariance therefore has the variance
added that the statistic has at least by chance in texts of this group's
lengths (``noise``). It comes from the data, no direction is flatter than it,
and concentration steps lower the determinant of the sum as they do without it.

Each step is one aggregation: moments are summed per group, start and distance
bin, and a running sum over the (bounded) bins finds the half. No group is
gathered anywhere, whatever its share of the rows.

Defined results: a null or empty text has no words and fails the base rules;
null languages and sources count as empty strings, missing columns as well;
groups of fewer than ``LEAST`` documents that pass the base rules are fitted
together as one, and are all kept if that has fewer still; repeated rows stay
rows and each counts in the estimate; rows at the same distance count together;
other columns, whatever their names, are left out by ``assess`` and kept by
``keep``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, as_texts, discard, map_batches, materialize, text_key

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
D = 4
#: Share of a group that the concentration steps keep, and quantiles of the reweighting and of the verdict: of documents with normal statistics, one in ten thousand goes.
COVER, REWEIGHT, REJECT = 0.5, 0.975, 0.9999
#: Documents that an estimate needs.
LEAST = 10 * D
#: Distance bins: so many to a factor of e in the squared distance. A half is taken to whole bins.
BINS = 1024
#: Fall of the logarithm of a determinant below which it falls no more.
EPSILON = 1e-6

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"


def base_counts(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and lines with a word."""
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats = 0
    if n > WINDOW:
        grams = list(zip(*(islice(words, k, None) for k in range(WINDOW))))
        if len(set(grams)) < len(grams):
            often = Counter(grams)
            end = 0
            for i, g in enumerate(grams):
                if often[g] > 1:
                    repeats += i + WINDOW - max(i, end)
                    end = i + WINDOW
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, len(lines)


_STATS = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,n_lines:bigint>"


def stats(text: str) -> Column:
    names = [x.split(":")[0] for x in _STATS[7:-1].split(",")]

    @F.arrow_udf(_STATS)
    def count(texts: pa.Array) -> pa.Array:
        rows = np.array([base_counts(t) for t in as_texts(texts)], np.int64).reshape(-1, len(names))
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(names))], names)

    return count.asNondeterministic()(F.col(text).cast("string"))


def base_failed(s: str = "s") -> Column:
    return (F.col(f"{s}.n_words") < MIN_WORDS) | (F.col(f"{s}.n_repeat_words") * 100 > F.col(f"{s}.n_words") * MAX_REPEAT_PERCENT)


def vector(s: str = "s") -> Column:
    """Transformed statistics; denominators are smoothed so that short texts stay near the middle."""
    n = {k: F.col(f"{s}.{k}").cast("double") for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")}
    return F.array(
        F.log((n["word_chars"] + 200.0) / (n["n_words"] + 40.0)),
        F.sqrt(n["n_symbols"] / (n["word_chars"] + 100.0)),
        F.sqrt(n["n_dup_lines"] / (n["n_lines"] + 5.0)),
        F.sqrt(n["n_repeat_words"] / (n["n_words"] + 40.0)),
    )


def noise(s: str = "s") -> Column:
    """Variances that the vector's statistics have by chance: of a mean over words, and of square roots of shares, a quarter for each unit that is counted. Words come to be repeated two windows at a time."""
    n = {k: F.col(f"{s}.{k}").cast("double") for k in ("n_words", "word_chars", "n_lines")}
    return F.array(1.0 / (n["n_words"] + 40.0), 0.25 / (n["word_chars"] + 100.0), 0.25 / (n["n_lines"] + 5.0), 0.25 * 2 * WINDOW / (n["n_words"] + 40.0))


def groups(df: DataFrame) -> list[Column]:
    return [(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(f"g_{c}") for c in ("lang", "source")]


KEYS = ["g_lang", "g_source"]
#: What groups that are too small are fitted as.
SMALL = "\x00small"


def chi2_quantile(p: float, dof: int) -> float:
    """By bisection on the regularised incomplete gamma function."""

    def below(x: float) -> float:
        a, z = dof / 2, x / 2
        term = total = 1 / a
        k = a
        while term > total * 1e-17:
            k += 1
            term *= z / k
            total += term
        return total * math.exp(a * math.log(z) - z - math.lgamma(a))

    lo, hi = 1e-12, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def distance(mean: str = "mean", precision: str = "precision") -> Column:
    """Squared Mahalanobis distance, unrolled so that it stays in generated code."""
    diff = [F.col("x")[i] - F.col(mean)[i] for i in range(D)]
    return sum((diff[i] * diff[j] * F.col(precision)[i * D + j] for i in range(D) for j in range(D)), F.lit(0.0))


_PAIRS = [(i, j) for i in range(D) for j in range(i, D)]
_SUMS = ["m0", *(f"a{i}" for i in range(D)), *(f"b{k}" for k in range(len(_PAIRS)))]
STARTS = ("mad", "signs", "tanh", "moments")
_KIND = pa.list_(pa.float64())
_ESTIMATE = "mean array<double>, precision array<double>, logdet double"


def _moments(of: str = "x") -> list[Column]:
    x = [F.col(of)[i] for i in range(D)]
    return [F.count("*").cast("double").alias("m0"), *(F.sum(c).alias(f"a{i}") for i, c in enumerate(x)), *(F.sum(x[i] * x[j]).alias(f"b{k}") for k, (i, j) in enumerate(_PAIRS))]


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: np.array(batch.column(c).to_pylist(), float) for c in batch.schema.names if c not in (*KEYS, "start")}


def _covariance(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of summed moments."""
    mean = np.stack([c[f"a{i}"] for i in range(D)], 1) / c["m0"][:, None]
    cov = np.zeros((len(mean), D, D))
    for k, (i, j) in enumerate(_PAIRS):
        cov[:, i, j] = cov[:, j, i] = c[f"b{k}"] / c["m0"] - mean[:, i] * mean[:, j]
    return mean, cov


def _diagonal(rows: np.ndarray) -> np.ndarray:
    return rows[:, :, None] * np.eye(D)


def first_estimate(start: str, centre: np.ndarray, scale: np.ndarray, noise: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance to start from: ``mean`` and ``cov`` are those of the start's transform of ``(x - centre) / scale``."""
    if start == "mad":
        return centre, np.diag(scale**2)
    if start == "moments":
        return centre + scale * mean, cov * np.outer(scale, scale) + np.diag(noise)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    return centre, cov / np.outer(spread, spread) * np.outer(scale, scale) + np.diag(noise)


def _batch(batch: pa.RecordBatch, mean: np.ndarray, cov: np.ndarray) -> pa.RecordBatch:
    keys = [c for c in (*KEYS, "start") if c in batch.schema.names]
    precision = np.linalg.inv(cov).reshape(len(cov), D * D)
    logdet = np.linalg.slogdet(cov)[1]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), pa.array(list(mean), _KIND), pa.array(list(precision), _KIND), pa.array(logdet)], names=[*keys, "mean", "precision", "logdet"])


def _started(moments: DataFrame) -> DataFrame:
    """``mean, precision, logdet`` of each group and start, from the moments of transformed vectors."""

    def make():
        def each(batch):
            c = _columns(batch)
            mean, cov = _covariance(c)
            both = [first_estimate(s, *args) for s, *args in zip(batch.column("start").to_pylist(), c["centre"], c["scale"], c["noise"], mean, cov)]
            # A start of few different vectors can be flat: it is made rounder, never dropped.
            cov = np.array([x[1] for x in both]) + _diagonal(c["noise"]) * 1e-3
            return _batch(batch, np.array([x[0] for x in both]), cov)

        return each

    return map_batches(moments, make, f"g_lang string, g_source string, start string, {_ESTIMATE}")


def _estimated(moments: DataFrame, scale: float, keys: list[str]) -> DataFrame:
    """``mean, precision, logdet`` of each group (and start), from the moments of a subset whose covariance is ``scale`` times too small, and ``noise``."""

    def make():
        def each(batch):
            c = _columns(batch)
            mean, cov = _covariance(c)
            return _batch(batch, mean, cov * scale + _diagonal(c["noise"]))

        return each

    return map_batches(moments.select(*keys, *_SUMS, "noise"), make, "".join(f"{k} string, " for k in keys) + _ESTIMATE)


def shrinkage(p: float) -> float:
    """The nearest ``p`` of a normal cloud has a covariance smaller than the cloud's; by this factor it is made up for."""
    return p / _chi2_cdf(chi2_quantile(p, D), D + 2)


def _short(df: DataFrame, name: str) -> DataFrame:
    """A table with a row or a few for each group, in few files: Spark sees how short it is, and does not deal vectors out by their group to join it."""
    return materialize(df.repartition(8), name)


def _centres(vectors: DataFrame) -> DataFrame:
    """``n, centre, scale, noise`` of each group: medians, MADs made wider by the noise, and the noise; from bounded sketches."""
    mid = vectors.groupBy(*KEYS).agg(F.count("*").alias("n"), F.array(*(F.percentile_approx(F.col("x")[i], 0.5, 10_000) for i in range(D))).alias("centre"), F.array(*(F.avg(F.col("t")[i]) for i in range(D))).alias("noise"))
    mid = _short(mid, "quality-medians")
    far = vectors.join(mid, KEYS).groupBy(*KEYS).agg(*(F.percentile_approx(F.abs(F.col("x")[i] - F.col("centre")[i]), 0.5, 10_000).alias(f"s{i}") for i in range(D)))
    wide = F.array(*(F.sqrt(F.pow(F.col(f"s{i}") * 1.4826, 2) + F.col("noise")[i]) for i in range(D)))
    return _short(mid.join(far, KEYS).select(*KEYS, "n", "centre", wide.alias("scale"), "noise"), "quality-centres")


def _starts(vectors: DataFrame, centres: DataFrame) -> DataFrame:
    z = F.array(*((F.col("x")[i] - F.col("centre")[i]) / F.col("scale")[i] for i in range(D)))
    scaled = vectors.join(centres, KEYS).select(*KEYS, z.alias("z"))
    length = F.sqrt(sum((F.col("z")[i] * F.col("z")[i] for i in range(D)), F.lit(0.0)))
    signs = F.transform("z", lambda v: F.when(length > 0, v / length).otherwise(F.lit(0.0)))
    each = {"mad": F.transform("z", lambda v: F.lit(0.0)), "signs": signs, "tanh": F.transform("z", F.tanh), "moments": F.col("z")}
    rows = scaled.select(*KEYS, F.inline(F.array(*(F.struct(F.lit(s).alias("start"), each[s].alias("y")) for s in STARTS))))
    return _started(rows.groupBy(*KEYS, "start").agg(*_moments("y")).join(centres, KEYS))


def _concentrated(vectors: DataFrame, now: DataFrame, centres: DataFrame) -> DataFrame:
    """One concentration step of each group and start in ``now``."""
    keys = [*KEYS, "start"]
    near = vectors.join(now, KEYS).select(*keys, "x", F.ceil(F.log(F.greatest(distance(), F.lit(1e-9))) * BINS).alias("bin"))
    by_bin = near.groupBy(*keys, "bin").agg(*_moments())
    run = Window.partitionBy(*keys).orderBy("bin")
    summed = by_bin.select(*keys, F.col("m0").alias("own"), F.sum("m0").over(Window.partitionBy(*keys)).alias("n"), *(F.sum(c).over(run).alias(c) for c in _SUMS))
    half = F.ceil((F.col("n") + D + 1) * F.lit(COVER))
    kept = summed.filter((F.col("m0") >= half) & (F.col("m0") - F.col("own") < half))
    return _estimated(kept.join(centres.select(*KEYS, "noise"), KEYS), shrinkage(COVER), keys)


def fit(vectors: DataFrame) -> DataFrame:
    """``g_lang, g_source, mean, precision`` of each group of ``vectors``: g_lang, g_source, x and its noise t."""
    keys = [*KEYS, "start"]
    centres = _centres(vectors)
    now = _short(_starts(vectors, centres).withColumn("logdet", F.lit(float("inf"))), "quality-starts")
    active = now
    while not active.isEmpty():
        step = _short(_concentrated(vectors, active, centres), "quality-step")
        # What falls no more is done; the steps lower each determinant, so all are in the end.
        fell = F.col("next.logdet") < F.col("now.logdet") - EPSILON
        met = now.alias("now").join(step.alias("next"), keys, "left")
        new = [F.when(fell, F.col(f"next.{c}")).otherwise(F.col(f"now.{c}")).alias(c) for c in ("mean", "precision", "logdet")]
        after = _short(met.select(*keys, *new, F.coalesce(fell, F.lit(False)).alias("fell")), "quality-now")
        for table in (step, now):
            discard(table)
        now, active = after, after.filter("fell").drop("fell")
    best = now.groupBy(*KEYS).agg(F.min(F.struct("logdet", "start", "mean", "precision")).alias("b")).select(*KEYS, "b.mean", "b.precision")
    inside = vectors.join(best, KEYS).filter(distance() <= max(chi2_quantile(REWEIGHT, D), chi2_quantile(COVER, D)))
    moments = inside.groupBy(*KEYS).agg(*_moments()).join(centres.select(*KEYS, "noise"), KEYS)
    out = _short(_estimated(moments, shrinkage(REWEIGHT), KEYS).drop("logdet"), "quality-fitted")
    for table in (now, centres):
        discard(table)
    return out


def _chi2_cdf(x: float, dof: int) -> float:
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_quantile(mid, dof) < x else (lo, mid)
    return lo


def _grouped(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``scored`` (with s and group columns) with ``x`` and the group that it is fitted in, and the estimates of these."""
    passed = scored.filter(~base_failed())
    sizes = passed.groupBy(*KEYS).agg(F.count("*").alias("n"))
    sizes = _short(sizes.select(*KEYS, (F.col("n") < LEAST).alias("small")), "quality-groups")
    small = F.coalesce("small", F.lit(True))

    def placed(df: DataFrame) -> DataFrame:
        own = df.join(sizes, KEYS, "left")
        return own.withColumns({k: F.when(small, F.lit(SMALL)).otherwise(F.col(k)) for k in KEYS}).drop("small").withColumn("x", vector())

    vectors = materialize(placed(passed).select(*KEYS, "x", noise().alias("t")), "quality-vectors")
    enough = _short(vectors.groupBy(*KEYS).agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST).select(*KEYS), "quality-enough")
    fitted = fit(vectors.join(enough, KEYS))
    for table in (vectors, enough):
        discard(table)
    return placed(scored), fitted


def verdict(scored: DataFrame, fitted: DataFrame) -> DataFrame:
    """``scored`` (with s, x and group columns) with ``base_failed``, ``distance2`` and ``kept``."""
    met = scored.join(fitted, KEYS, "left").withColumn("distance2", distance())
    # What has no estimate has nothing to be far from.
    return met.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= chi2_quantile(REJECT, D)))


def assess(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, the statistics, ``base_failed``, ``distance2`` and ``kept``."""
    counted = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *groups(docs), stats("text").alias("s")), "quality-stats")
    return verdict(*_grouped(counted)).select("doc_id", "s.n_words", "s.word_chars", "s.n_symbols", "s.n_dup_lines", "s.n_repeat_words", "base_failed", "kept", "distance2")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    The verdicts are joined to the rows by id and a hash of the text: equal rows
    of a group have equal verdicts, and texts are counted once.
    """
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), text_key("text").alias("k")]
    counted = materialize(docs.select(*key, *(c.alias(f"own_{c_name}") for c, c_name in zip(groups(docs), KEYS)), *groups(docs), stats("text").alias("s")), "quality-stats")
    own = [f"own_{k}" for k in KEYS]
    kept = verdict(*_grouped(counted)).filter("kept").select("doc", "k", *own).distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.select(row, *key, *(c.alias(o) for c, o in zip(groups(docs), own)))
    return keyed.join(materialize(kept, "quality-kept"), ["doc", "k", *own], "left_semi").select("row.*")
