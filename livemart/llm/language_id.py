"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its subwords: byte n-grams of its
lower-cased words, word ends included, hashed into 2**``BITS`` buckets.  A
linear softmax on the mean gives the language.  Embeddings and softmax are
trained together by stochastic gradient descent in numpy on a bounded sample
(``per_lang`` labelled documents of each language, in the order of a hash of
the row).  A part of the sample is kept from training: on it a temperature is
fitted, so the score is a calibrated probability, and the rejection threshold
is set to the score that ``reject_share`` of the rightly predicted kept
documents stay below.

Result per row: doc_id, lang_pred, score (0 to 1), accepted (score reaches the
rejection threshold).

Defined cases: a text that is null or has no letter (Unicode) is ``und`` with
score 0, not accepted; so is every text when nothing could be learned;
documents without a language, a text or an id are not learned from; null ids are
predicted like others; repeated rows get equal rows; an empty table gives an empty
result; columns of other names may be called anything.  Only ``text`` is an input of the
prediction; whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemart.llm._words import U64, column_buffers, lowered, mix64, row_groups

BITS = 16
ORDERS = (2, 3, 4)
_GROUP_BYTES = 2 << 20
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # per bucket, its share in each language's logit
    bias: np.ndarray
    temperature: float
    reject_below: float


def subwords(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of the subwords of a group of rows, one n-gram length at a time."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    offsets = offsets - lo
    raw = lowered(data[lo:hi])
    raw[~_LETTER[data[lo:hi]]] = 32
    raw = np.append(np.insert(raw, offsets[:-1], 32), np.uint8(32))  # a space before each row and at the end
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 1)
    space, wide = raw == 32, raw.astype(np.uint32)
    for n in ORDERS:
        size = len(raw) - n + 1
        if size <= 0:
            continue
        good = np.ones(size, dtype=bool)
        code = np.zeros(size, dtype=np.uint32)
        for k in range(n):
            if 0 < k < n - 1:
                good &= ~space[k:k + size]
            code = (code << np.uint32(8)) | wide[k:k + size]
        if n == 2:  # longer grams hold a letter, their inner bytes
            good &= ~(space[:size] & space[1:1 + size])
        at = np.flatnonzero(good)
        yield row[at], (mix64(code[at].astype(U64) + U64(n << 40)) >> U64(64 - BITS)).astype(np.int64)


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = column_buffers(batch.column("text"))
        lists, counts = [], []
        for k in range(batch.num_rows):
            total: np.ndarray | int = 0
            for _, bucket in subwords(offsets[k:k + 2], data):
                total = total + np.bincount(bucket, minlength=1 << BITS)
            used = np.flatnonzero(total)
            lists.append(used.astype(np.int32))
            counts.append(np.asarray(total)[used].astype(np.float32) if len(used) else np.zeros(0, np.float32))
        yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "buckets": pa.array(lists, pa.list_(pa.int32())),
                                          "counts": pa.array(counts, pa.list_(pa.float32()))})


def _sampled(docs: DataFrame, per_lang: int) -> DataFrame:
    """(lang, text) of at most ``per_lang`` rows of each language, in the order of a hash of the row.

    Only hashes below a bound, which about ``4 * per_lang`` different rows of the language
    reach, are ranked: the ranking reads few rows, whatever the corpus and however rows repeat.
    """
    known = (docs.where("lang is not null and text is not null and doc_id is not null")
             .select("lang", "doc_id", "text", F.xxhash64("doc_id", "text").alias("draw")))
    share = F.least(F.lit(1.0), 4 * per_lang / F.approx_count_distinct("draw"))
    bound = known.groupBy(F.col("lang").alias("of")).agg((share * 2.0 ** 64 - 2.0 ** 63).alias("most"))
    # one row a language, as many as the model's table has columns: never a large table
    few = known.join(F.broadcast(bound), F.col("lang") == F.col("of")).where(F.col("draw").cast("double") <= F.col("most"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
    return few.withColumn("rank", rank).where(F.col("rank") <= per_lang)


def fit(docs: DataFrame, per_lang: int = 400, dim: int = 16, epochs: int = 5, rate: float = 0.5,
        reject_share: float = 0.01, seed: int = 7) -> Model:
    """Train on at most ``per_lang`` documents of each language of ``docs`` (doc_id, text, lang)."""
    rows = (_sampled(docs, per_lang).select("lang", "text")
            .mapInArrow(_sample, "lang string, buckets array<int>, counts array<float>").toArrow())
    langs = sorted(set(rows.column("lang").to_pylist()))
    number = {lang: k for k, lang in enumerate(langs)}
    examples = [(b.values.to_numpy(), c.values.to_numpy(), number[lang.as_py()])
                for lang, b, c in zip(rows.column("lang"), rows.column("buckets"), rows.column("counts"), strict=True)
                if len(b.values)]
    rng = np.random.default_rng(seed)
    examples = [examples[k] for k in rng.permutation(len(examples))]
    kept, examples = examples[:len(examples) // 5], examples[len(examples) // 5:]
    inner = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim))
    outer, bias = np.zeros((dim, len(langs))), np.zeros(len(langs))
    total, done = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            bucket, count, target = examples[k]
            share = count / count.sum()
            mean = share @ inner[bucket]
            p = _softmax(mean @ outer + bias)
            p[target] -= 1
            step = rate * (1 - done / total)
            back = outer @ p
            outer -= step * np.outer(mean, p)
            bias -= step * 0.1 * p
            inner[bucket] -= step * np.outer(share * min(len(bucket), 50), back)
            done += 1
    table = inner @ outer
    logits = np.array([(c / c.sum()) @ table[b] + bias for b, c, _ in kept])
    target = np.array([t for _, _, t in kept], dtype=np.int64)
    temperature, reject_below = _calibrate(logits, target, reject_share)
    return Model(langs, table.astype(np.float32), bias, temperature, reject_below)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _calibrate(logits: np.ndarray, target: np.ndarray, reject_share: float) -> tuple[float, float]:
    """Temperature of the least log loss on the kept documents, and the rejection threshold."""
    if not len(target):
        return 1.0, 0.0
    at = np.arange(len(target))
    grid = np.geomspace(0.25, 8, 41)
    loss = [-np.log(np.maximum(_softmax(logits / t)[at, target], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(logits / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == target]
    return temperature, float(np.quantile(right, reject_share)) if len(right) else 0.0


def _predict(shared, keep: tuple[str, ...]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        langs = np.array([*model.langs, "und"], dtype=object)
        for batch in batches:
            offsets, data = column_buffers(batch.column("text"))
            letters = batch.column("has_letter").to_numpy(zero_copy_only=False)
            best, score = np.full(batch.num_rows, len(model.langs)), np.zeros(batch.num_rows)
            for i, j in row_groups(offsets, _GROUP_BYTES):
                if not model.langs:
                    break
                sums, n = np.zeros((j - i, len(model.langs))), np.zeros(j - i)
                for row, bucket in subwords(offsets[i:j + 1], data):
                    n += np.bincount(row, minlength=j - i)
                    for k in range(len(model.langs)):
                        sums[:, k] += np.bincount(row, weights=model.table[bucket, k], minlength=j - i)
                p = _softmax((sums / np.maximum(n, 1)[:, None] + model.bias) / model.temperature)
                best[i:j], score[i:j] = p.argmax(axis=1), p.max(axis=1)
            none = ~letters.astype(bool)
            best[none], score[none] = len(model.langs), 0.0
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), **{c: batch.column(c) for c in keep},
                "lang_pred": pa.array(langs[best], pa.string()), "score": score,
                "accepted": (score >= model.reject_below) & (best < len(model.langs))})
    return predict


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """Language of every row of ``docs``; columns named in ``keep`` are carried along."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    carried = "".join(f", {c} {slim.schema[c].dataType.simpleString()}" for c in keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return slim.mapInArrow(_predict(shared, tuple(keep)),
                           f"doc_id long{carried}, lang_pred string, score double, accepted boolean")
