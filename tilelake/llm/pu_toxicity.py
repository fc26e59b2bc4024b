"""Toxicity scores by non-negative positive-unlabelled learning.

Linear numpy classifiers are trained from confirmed toxic documents and unlabelled ones. The risk
of an unlabelled document counts as a clean one's after the share that toxic documents explain,
the class prior times the positives' own, is taken off; where that estimate turns negative the step
goes back up instead, so the model can't buy risk by calling the positives it memorised clean.

Ids are sampled first, without reading a text, then one task trains each classifier on its own
bounded sample, and the mean of their outputs scores every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import fresh, map_columns, narrow
from tilelake.session import materialize

# The fit's documented bounds: rows per classifier, and features a classifier may weigh.
MODELS = 3
POSITIVES = 3000
UNLABELLED = 6000
FEATURES = 8192
LEAST = 8  # documents of a sample that a feature must be in
STEPS = 800
RATE = 0.05
DECAY = 1e-4
BIAS = -1  # the feature that every document has
THRESHOLD = 0.3
REMEMBERED = 100_000  # words whose features a task keeps; results do not depend on it

_WORDS = re.compile(r"\w+")


def features_of(word: str) -> tuple[int, ...]:
    """A word and its beginnings of three to six letters, as signed hashes of 63 bits."""
    parts = {f"={word}", *(f"{n}{word[:n]}" for n in (3, 4, 5, 6) if len(word) >= n)}
    return tuple(xxhash.xxh64_intdigest(p) >> 1 for p in parts)


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def _featurise():
    known: dict[str, tuple[int, ...]] = {}

    def step(batch):
        rows = []
        for text in batch["text"]:
            found: set[int] = set()
            for w in set(_WORDS.findall((text.as_py() or "").lower())):
                if (got := known.get(w)) is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    got = known[w] = features_of(w)
                found.update(got)
            rows.append(list(found))
        return {n: c for n, c in batch.items() if n != "text"} | {"features": rows}

    return step


def frequent(values: np.ndarray, least: int = LEAST, buckets: int = 1 << 22) -> np.ndarray:
    """Where ``values`` may occur ``least`` times: what shares a bucket with too few others is left out.

    The rest fits in memory several times; nothing is lost that ``fit`` would use.
    """
    counts = np.zeros(buckets, np.int32)
    steps = range(0, len(values), 1 << 20)
    for i in steps:
        counts += np.bincount(values[i:i + (1 << 20)] & (buckets - 1), minlength=buckets).astype(np.int32)
    return np.concatenate([np.flatnonzero(counts[values[i:i + (1 << 20)] & (buckets - 1)] >= least) + i for i in steps] or [np.empty(0, np.int64)])


def fit(values: np.ndarray, doc: np.ndarray, positive: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and weights (the bias under ``BIAS``) from documents' different features.

    ``values`` holds a feature each, ``doc`` the number of its document, ``positive`` a flag per document.
    """
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    names, at = np.unique(values, return_inverse=True)
    in_p = np.bincount(at[positive[doc]], minlength=len(names))
    in_u = np.bincount(at[~positive[doc]], minlength=len(names))
    # Features that tell positives from the rest: they are in several documents, and twice as often in one side.
    lift = np.log((in_p + 0.5) / (n_p + 1)) - np.log((in_u + 0.5) / (n_u + 1))
    useful = np.flatnonzero((in_p + in_u >= LEAST) & (np.abs(lift) >= np.log(2)))
    useful = useful[np.lexsort((names[useful], -np.abs(lift[useful])))][:FEATURES]
    column = np.full(len(names), -1)
    column[useful] = np.arange(len(useful))
    keep = column[at] >= 0
    row, col = doc[keep], column[at[keep]]
    by = np.lexsort((col, row))  # sums in a fixed order make reruns agree
    row, col = row[by], col[by]

    weights = np.zeros(len(useful) + 1)  # the last is the bias
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, STEPS + 1):
        grad = gradient(row, col, positive, weights, prior)
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        weights -= RATE * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return np.append(names[useful], BIAS), weights


def gradient(row: np.ndarray, col: np.ndarray, positive: np.ndarray, weights: np.ndarray, prior: float) -> np.ndarray:
    """Step direction of the non-negative risk, for documents ``row`` with features ``col`` and the bias last."""
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    f = np.bincount(row, weights[col], minlength=len(positive)) + weights[-1]
    s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    # The sigmoid loss, which is bounded: a prior that is a little off can't outweigh the clean documents.
    rest = s[~positive].mean() - prior * s[positive].mean()
    steep = s * (1 - s)
    slope = np.where(positive, -prior / n_p, 1 / n_u) * steep  # of what is left of the clean risk
    slope = slope - np.where(positive, prior / n_p, 0) * steep if rest >= 0 else -slope
    return np.append(np.bincount(col, slope[row], minlength=len(weights) - 1), slope.sum()) + DECAY * weights


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    prior: float | None = None, models: int = MODELS, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> dict[int, float]:
    """Mean weights by feature of ``models`` classifiers; empty if there are no positives to learn from.

    Labels of held-out rows are never read. A document is positive if any of its label rows says so.
    ``prior`` is the share of toxic documents; by default their share of all labels in the fold. It is
    held between 0.001 and 0.9. Null ids and null labels teach nothing; ids that repeat are drawn once, with
    all their rows' texts; null texts are empty. Very long texts are read whole. Of features that tell
    equally much those with the smaller hashes are taken. Empty tables give no weights. Other columns are ignored.
    """
    known = narrow(labels, doc_id=id_col, toxic=label_col).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return {}
    prior = min(max(prior, 1e-3), 0.9)
    dice = F.xxhash64(F.lit("pu"), F.col("doc_id").cast("string"))

    def sample(ids: DataFrame, kind: str, most: int) -> DataFrame:
        # A top-k per task, then of those: bounded however large the table is.
        return ids.select("doc_id", dice.alias("dice")).distinct().orderBy("dice", "doc_id").limit(most * models).select(
            "doc_id", F.lit(kind == "p").alias("positive"), F.pmod(F.xxhash64("dice"), F.lit(models)).cast("int").alias("model"))

    chosen = materialize(
        sample(known.where("toxic = 1"), "p", positives).unionByName(
            sample(narrow(docs, doc_id=id_col).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), "u", unlabelled)), "sample")
    rows = narrow(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id")  # bounded by the sample sizes
    rows = map_columns(rows.select("doc_id", "model", "positive", "text"), _featurise, "model int, positive boolean, features array<long>")

    def train_one(part: pa.Table) -> pa.Table:
        positive = part.column("positive").to_numpy()
        lists = part.column("features").combine_chunks()
        doc = np.repeat(np.arange(len(positive), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        values = lists.flatten().to_numpy()
        keep = frequent(values)
        values, doc = values[keep], doc[keep]
        del part, lists
        if not positive.any() or positive.all():
            return pa.table({"feature": pa.array([], pa.int64()), "weight": pa.array([], pa.float64())})
        # Rows come in any order: documents are numbered by what they hold.
        held = np.bincount(doc, minlength=len(positive))
        mark = np.zeros(len(positive), np.uint64)
        np.add.at(mark, doc, values.view(np.uint64))
        order = np.lexsort((mark, held, ~positive))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        names, weights = fit(values, number[doc], positive[order], prior)
        return pa.table({"feature": names, "weight": weights})

    got = materialize(rows.groupBy("model").applyInArrow(train_one, "feature long, weight double"), "weights")
    fitted = got.where(F.col("feature") == BIAS).count()
    # At most models * (FEATURES + 1) rows.
    return {r.feature: r.weight / fitted for r in got.groupBy("feature").agg(F.sort_array(F.collect_list("weight")).alias("w")).select(
        "feature", F.aggregate("w", F.lit(0.0), lambda a, x: a + x).alias("weight")).collect()}


def scores(docs: DataFrame, weights: dict[int, float], text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1. Null counts as empty, which scores as the bias
    alone does; without a model every score is 0. Repeated rows and null ids score as any others,
    very long texts whole; no rows: no rows. A column called ``out`` is replaced, all others stay."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weight = model.value
        bias = weight.get(BIAS, -np.inf)
        known: dict[str, tuple[tuple[int, float], ...]] = {}
        for texts in parts:
            sums = []
            for text in texts:
                found: dict[int, float] = {}
                for w in set(_WORDS.findall((text or "").lower())):
                    if (got := known.get(w)) is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        got = known[w] = tuple((f, weight[f]) for f in features_of(w) if f in weight)
                    if got:
                        found.update(got)
                sums.append(bias + sum(found[f] for f in sorted(found)))
            logits = np.array(sums, float)
            yield pd.Series(np.where(np.isneginf(logits), 0.0, 1 / (1 + np.exp(-np.clip(logits, -500, 500)))))

    rest = [F.col(f"`{c}`") for c in docs.columns if c != out]
    return docs.select(*rest, of(F.col(f"`{text_col}`")).alias(out))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns: every document's score and prediction; a null id isn't held out."""
    weights = train(docs, labels)
    return scores(narrow(docs, doc_id="doc_id", text="text"), weights).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Documents whose score is below ``threshold``, with all their columns."""
    (mark,) = fresh(docs, "_score")
    weights = train(docs, labels, text_col=text_col)
    return scores(docs, weights, text_col, mark).where(F.col(mark) < threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
