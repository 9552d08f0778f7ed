"""Toxicity: cumulative-link ordinal regression on sparse text features.

Grades (ordered) come from the labelled table: 0 harmless text of good
quality, 1 poor but harmless text, 2 toxic text.  The model is a proportional-odds
logit, P(grade <= k) = sigmoid(theta_k - w.x): one weight vector shared by
all ordered thresholds theta_0 < theta_1.  x holds hashed binary features of
the whole text: the lower-cased words (runs of letters), the stems that they
begin with (proper prefixes of 4 to 7 bytes), and each of these occurring at
least twice; and the bin of each statistic of the text's shape (length, shares of
symbols, capitals, line breaks and different words), which tell poor text from good.

Fit: on a bounded sample of labelled rows, at most ``per_grade`` documents of
each grade in the order of a hash of the id, weighted back to the grades'
shares.  Features bound to the toxic grade no more than chance allows are
left out; the rest are fitted by projected gradient steps with a small ridge
in numpy on the driver.  An id may be on any number of rows: ``per_grade`` bounds the rows.
Weights of words are kept at or above zero: a word can only add to the severity, so
harmless text around toxic words never hides them.  Those of the shape, one feature
a statistic whatever the length, have either sign.
The broadcast weights are about 2**``BITS`` floats (8 MB) whatever the corpus.

Result, one row per document: doc_id, p_poor = P(grade >= 1), p_toxic =
P(grade >= 2), expected_severity = their sum (the expected grade), toxic =
p_toxic >= ``cut``.

Defined cases: texts that are null or have no letters score 0 and are not
toxic; labels that are null or without a document are not used, of several
labels of a document the highest grade counts; without any toxic label every
score is 0; null ids are kept; repeated rows get equal rows; an empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemart.llm._words import U64, column_buffers, letter_words, mix64, row_groups

BITS = 20
PREFIXES = (4, 5, 6, 7)  # bytes
LEVELS = 2
SHAPES, BINS = 5, 16
FEATURES = (1 << BITS) + SHAPES * BINS
_SYMBOL, _CAPITAL, _LINE = (np.zeros(256, dtype=np.int64) for _ in range(3))
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,"]] = 1
_CAPITAL[65:91] = 1
_LINE[10] = 1
GRADES = 3
TOXIC = GRADES - 1
_GROUP_BYTES = 4 << 20


@dataclass
class Model:
    weights: np.ndarray     # one per hashed word
    thresholds: np.ndarray  # increasing, one less than the grades
    graded: bool            # False when no toxic label was there to learn from


def shapes(offsets: np.ndarray, data: np.ndarray, row: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The bin (0 to BINS - 1) of each statistic (column) of each text (row)."""
    lo, n = int(offsets[0]), len(offsets) - 1
    raw, cuts = data[lo:int(offsets[-1])], offsets - lo
    size = np.maximum(np.diff(cuts), 1)

    def count(kind: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(kind[raw])][cuts])
    order = np.lexsort((words, row))
    fresh = np.r_[True, (row[order][1:] != row[order][:-1]) | (words[order][1:] != words[order][:-1])][:len(order)]
    different = np.bincount(row[order][fresh], minlength=n)
    found = [np.log2(size), 32 * count(_SYMBOL) / size, BINS * count(_CAPITAL) / size, 128 * count(_LINE) / size,
             BINS * different / np.maximum(np.bincount(row, minlength=n), 1)]
    return np.minimum(np.stack(found, axis=1).astype(np.int64), BINS - 1)


def features(offsets: np.ndarray, data: np.ndarray, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each once, ordered by row; ``used`` (a mask) names the features of interest."""
    row, found = letter_words(offsets, data, PREFIXES)
    bins = shapes(offsets, data, row, found[0][1])
    n = len(bins)
    shape = (1 << BITS) + np.arange(SHAPES)[None, :] * BINS + bins
    pairs = [((np.arange(n)[:, None] << (BITS + 1)) | shape).ravel().astype(U64)]
    for n, (word, value) in enumerate(found):
        value = mix64(value + U64(n))
        for level in range(LEVELS):
            feature = mix64(value + U64(level)) >> U64(64 - BITS)
            want = slice(None) if used is None else used[feature.astype(np.int64)]
            code, count = np.unique((row[word[want]].astype(U64) << U64(BITS + 1)) | feature[want], return_counts=True)
            pairs.append(code[count > level])
    pairs = np.unique(np.concatenate(pairs))
    return (pairs >> U64(BITS + 1)).astype(np.int64), (pairs & U64((1 << (BITS + 1)) - 1)).astype(np.int64)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = column_buffers(batch.column("text"))
        for i, j in row_groups(offsets, _GROUP_BYTES):
            row, feature = features(offsets[i:j + 1], data)
            cuts = np.searchsorted(row, np.arange(j - i + 1))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("grade").slice(i, j - i), lists], names=["grade", "features"])


def graded_labels(labels: DataFrame) -> DataFrame:
    """(label_id, grade) of the labelled documents."""
    grade = F.when(F.col("toxic") != 0, 2).when(F.col("quality") == 0, 1).otherwise(0)
    return (labels.where("doc_id is not null and toxic is not null")
            .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(grade).alias("grade")))


def fit(docs: DataFrame, labels: DataFrame, per_grade: int = 3000, min_docs: int = 3, false_features: float = 20.0,
        ridge: float = 1e-5, shape_ridge: float = 3e-3, steps: int = 300) -> Model:
    """Learn the weights and thresholds from at most ``per_grade`` labelled documents of each grade."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    graded = graded_labels(labels)
    totals = dict(graded.groupBy("grade").count().collect())  # at most one row per grade
    if not totals.get(TOXIC) or len(totals) < 2:
        return Model(np.zeros(FEATURES), np.arange(1.0, GRADES), False)
    parts = [graded.where(F.col("grade") == g).orderBy(F.xxhash64("label_id"), "label_id").limit(per_grade)
             for g in range(GRADES)]
    chosen = parts[0].union(parts[1]).union(parts[2])  # at most GRADES * per_grade ids
    met = docs.where("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    # an id may be on any number of rows; the sample stays bounded all the same
    rank = F.row_number().over(Window.partitionBy("grade").orderBy(F.xxhash64("label_id", "text"), "label_id"))
    rows = (met.withColumn("rank", rank).where(F.col("rank") <= per_grade)
            .select("grade", "text").mapInArrow(_sample_features, "grade int, features array<int>").toArrow())
    grade = rows.column("grade").to_numpy()
    lists = rows.column("features").combine_chunks()
    size, flat = np.diff(lists.offsets.to_numpy()), lists.values.to_numpy()
    used = np.flatnonzero(np.bincount(flat, minlength=FEATURES) >= min_docs) if len(flat) else np.zeros(0, np.int64)
    place = np.full(FEATURES, -1)
    place[used] = np.arange(len(used))
    row, col = np.repeat(np.arange(len(size)), size), place[flat]
    row, col = row[col >= 0], col[col >= 0]
    here = np.bincount(grade, minlength=GRADES)
    weight = np.array([totals.get(g, 0) / max(here[g], 1) for g in range(GRADES)])[grade]
    weight = weight / weight.sum()
    # screening: features bound to the toxic grade beyond chance (Chernoff bound of the binomial tail,
    # about ``false_features`` expected by chance among all that were tested)
    base = float(np.clip(weight[grade == TOXIC].sum(), 1e-6, 1 - 1e-6))
    n_docs = np.bincount(col, minlength=len(used))
    rate = np.clip(np.bincount(col, weights=(weight * (grade == TOXIC))[row], minlength=len(used))
                   / np.maximum(np.bincount(col, weights=weight[row], minlength=len(used)), 1e-12), 1e-9, 1 - 1e-9)
    surprise = n_docs * (rate * np.log(rate / base) + (1 - rate) * np.log((1 - rate) / (1 - base)))
    word = used < 1 << BITS
    chosen = np.flatnonzero(~word | ((rate > base) & (surprise > np.log(max(len(used), 1) / false_features))))
    again = np.full(len(used), -1)
    again[chosen] = np.arange(len(chosen))
    row, col = row[again[col] >= 0], again[col[again[col] >= 0]]
    return _train(row, col, grade, weight, used[chosen], ridge, shape_ridge, steps)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _train(row, col, grade, weight, used, ridge: float, shape_ridge: float, steps: int) -> Model:
    n = len(grade)
    ridge = np.where(used < 1 << BITS, ridge, shape_ridge)
    below = np.clip([weight[grade <= k].sum() for k in range(GRADES - 1)], 1e-3, 1 - 1e-3)
    # thresholds as a first value and positive gaps, so they stay ordered
    start = np.log(below / (1 - below))
    params = np.concatenate((np.zeros(len(used)), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, first, gaps = params[:len(used)], params[len(used)], np.exp(params[len(used) + 1:])
        theta = first + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(row, weights=w[col], minlength=n)
        upper = np.where(grade < GRADES - 1, _sigmoid(theta[np.minimum(grade, GRADES - 2)] - score), 1.0)
        lower = np.where(grade > 0, _sigmoid(theta[np.maximum(grade - 1, 0)] - score), 0.0)
        share = weight / np.maximum(upper - lower, 1e-9)
        up, down = share * upper * (1 - upper), share * lower * (1 - lower)
        d_score = up - down  # of the negative log-likelihood
        d_theta = np.array([down[grade == k + 1].sum() - up[grade == k].sum() for k in range(GRADES - 1)])
        grad = np.concatenate((np.bincount(col, weights=d_score[row], minlength=len(used)) + ridge * w, [d_theta.sum()],
                               [d_theta[k + 1:].sum() * gaps[k] for k in range(GRADES - 2)]))
        mean = 0.9 * mean + 0.1 * grad
        square = 0.98 * square + 0.02 * grad ** 2
        rate = 0.1 * min(1.0, 2 * (1 - step / (steps + 1)))
        scale = rate / (np.sqrt(square / (1 - 0.98 ** step)) + 1e-6)
        params = params - scale * mean / (1 - 0.9 ** step)
        w = params[:len(used)]
        params[:len(used)] = np.where(used < 1 << BITS, np.maximum(w, 0), w)
    weights = np.zeros(FEATURES)
    weights[used] = params[:len(used)]
    theta = params[len(used)] + np.concatenate(([0.0], np.cumsum(np.exp(params[len(used) + 1:]))))
    return Model(weights, theta, True)


def _predict(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        used = model.weights != 0
        for batch in batches:
            offsets, data = column_buffers(batch.column("text"))
            p = np.zeros((batch.num_rows, GRADES - 1))
            for i, j in row_groups(offsets, _GROUP_BYTES):
                if not model.graded:
                    break
                row, feature = features(offsets[i:j + 1], data, used)
                score = np.bincount(row, weights=model.weights[feature], minlength=j - i)
                p[i:j] = 1 - _sigmoid(model.thresholds[None, :] - score[:, None])
            p[~batch.column("has_letter").to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "p_poor": p[:, 0], "p_toxic": p[:, 1],
                "expected_severity": p.sum(axis=1)})
    return predict


def score(docs: DataFrame, model: Model, cut: float = 0.5) -> DataFrame:
    """Severity of every row of ``docs``."""
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _has_letter().alias("has_letter"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(shared), "doc_id long, p_poor double, p_toxic double, expected_severity double") \
        .withColumn("toxic", F.col("p_toxic") >= cut)


def without_toxic(docs: DataFrame, model: Model, cut: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not toxic, judged row by row without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{k}" for k in range(len(docs.columns))]  # names of the input may clash with ours
    place = docs.columns.index("text")
    plain = docs.toDF(*names)
    judged = plain.withColumn("has_letter", _has_letter(names[place]))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _predict(shared)
        for batch in batches:
            slim = pa.RecordBatch.from_arrays(
                [pa.nulls(batch.num_rows, pa.int64()), batch.column(place), batch.column(batch.num_columns - 1)],
                names=["doc_id", "text", "has_letter"])
            found = next(predict(iter([slim])))
            yield batch.select(names).filter(pa.array(found.column("p_toxic").to_numpy() < cut))
    return judged.mapInArrow(keep, plain.schema).toDF(*docs.columns)


def _has_letter(name: str = "text"):
    return F.coalesce(F.col(name).cast("string").rlike(r"\p{L}"), F.lit(False))
