"""Soft-membership mixing of documents to target domain weights.

1. A classifier learned from the labelled table gives each document its
   posterior over domains: naive Bayes on binned text statistics (length, word
   length, shares of symbols, capitals, repeated words, line breaks).  It
   learns from all labelled documents by one aggregate of counts.
2. Posteriors are rounded to a grid of 1/``GRID``; documents in one cell are
   alike in all that follows, so the fit reads one row per cell (sums of
   tokens), however many documents there are and however they are skewed.
3. Distributed least squares finds document rates whose expected token totals,
   sum of rate * tokens * posterior, match the targets, every rate within
   ``bounds``.  Projected gradient: from rates of 1 each step moves a rate against the
   gradient of the squared distance from the targets, adds momentum and
   projects it on the bounds.  The distance is weighted by the inverse K x K Gram matrix of the
   posteriors, so a step that meets no bound is exact.  A step is K numbers: the
   rate of a cell, or of a document, is the fold of the steps over its posterior,
   and a step costs one aggregate of K totals over the cells.  ``residual``
   tells by how much of the corpus the worst domain is off its target.
4. A document is taken floor(rate + u) times, u uniform from a hash of the row:
   a map over the documents, without a shuffle of texts.

A domain is a quality of the labelled table.  Target totals are shares of the
corpus' own tokens: ``weights`` of the caller, or the shares of the domains in the
labelled documents' tokens.  So the default neither thins nor swells the corpus; with other
weights no document is left out or repeated beyond the bounds, and what they leave
open is the residual.  The data path uses DataFrame functions only.

Defined cases: null and empty texts have no tokens, get the prior as posterior
and a rate like others; labels that are null or without a document are not
used; of several labels of a document the largest counts; without labels all
rates are 1; a target domain that no document belongs to is left out of the
targets; null ids are kept; repeated rows are rows like others, with the same
rate and copies; whole texts of any length are described; an empty table
gives an empty result.  Columns of ``docs`` may have any names: ``mixed`` keeps them all.
"""

from __future__ import annotations

import json
import logging
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livemart.llm._shared import written

GRID = 50
BINS = 16
STATISTICS = 6
SOFTEN = 2.0  # the statistics are not independent: log odds are divided by this
TOLERANCE = 1e-4
BOUNDS = (0.25, 4.0)


@dataclass(frozen=True)
class Mixer:
    """A fitted mixing: class counts of the domains, the gradient steps of the rates, and what they leave open."""

    domains: tuple[str, ...]
    counts: dict
    steps: tuple[tuple[float, ...], ...]
    bounds: tuple[float, float]
    residual: float


def statistics(text: Column) -> list[Column]:
    """Bin numbers (0 to BINS - 1) of a text's statistics."""
    chars = F.greatest(F.length(text), F.lit(1))
    words = F.split(text, r"[ \t-\r]+")
    n = F.greatest(F.size(words), F.lit(1))

    def share(pattern: str, scale: int) -> Column:
        return (chars - F.length(F.regexp_replace(text, pattern, ""))) / chars * scale
    found = [F.log2(n), chars / n, share(r"[^\p{L}\p{N}\s.,]+", 32), share(r"\p{Lu}+", BINS),
             F.size(F.array_distinct(words)) / n * BINS, share(r"\n+", 128)]
    return [F.least(F.floor(x), F.lit(BINS - 1)).cast("int") for x in found]


def _description(doc_id: str, text: str) -> dict[str, Column]:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    tokens = F.when(F.trim(F.translate(whole, "\t\n\x0b\x0c\r", "     ")) == "", 0).otherwise(
        F.regexp_count(whole, F.lit(r"[^ \t-\r]+"))).cast("long")
    return {"tokens": tokens, "draw": F.xxhash64(doc_id, text), "bins": F.array(*statistics(whole))}


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, tokens, draw, bins) of every row of ``docs`` (doc_id, text), written."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       *[c.alias(n) for n, c in _description("doc_id", "text").items()])
    return written(rows, "described")


def domain_of_labels(labels: DataFrame) -> DataFrame:
    """(label_id, domain): the quality of a labelled document is its domain."""
    return (labels.where("doc_id is not null and quality is not null")
            .groupBy(F.col("doc_id").cast("long").alias("label_id"))
            .agg(F.max("quality").cast("string").alias("domain")))


def _posteriors(domains: tuple[str, ...], counts: dict) -> list[Column]:
    """Posterior expressions on the grid from counts {(domain, statistic, bin): documents}."""
    scores = []
    every = sum(counts[d, -1, 0] for d in domains)
    for d in domains:
        here = counts[d, -1, 0]
        table = [math.log((counts.get((d, s, b), 0) + 1) / (here + BINS)) / SOFTEN for s in range(STATISTICS)
                 for b in range(BINS)]
        literal = F.lit(table)
        score = F.lit(math.log(here / every))
        for s in range(STATISTICS):
            score = score + F.get(literal, F.get("bins", s) + s * BINS)
        scores.append(score)
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = sum(parts[1:], parts[0])
    return [F.when(F.col("tokens") > 0, F.round(p / total * GRID)).otherwise(
        F.round(F.lit(GRID * counts[d, -1, 0] / every))).cast("int") for d, p in zip(domains, parts, strict=True)]


def _shares(names: list[str]) -> list[Column]:
    """Grid columns as posteriors that sum to 1."""
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    return [F.col(c) / total for c in names]


def rate_of(posterior: list[Column], steps, bounds: tuple[float, float]) -> Column:
    """The rate after the gradient ``steps``, each (momentum, K numbers): 1 without any."""
    if not steps:
        return F.lit(1.0)

    k = len(posterior)

    def step(state: Column, move: Column) -> Column:
        ahead = state["now"] + F.get(move, 0) * (state["now"] - state["last"])
        for d in range(k):
            ahead = ahead - state[f"p{d}"] * F.get(move, d + 1)
        return F.struct(F.least(F.lit(bounds[1]), F.greatest(F.lit(bounds[0]), ahead)).alias("now"),
                        state["now"].alias("last"), *[state[f"p{d}"].alias(f"p{d}") for d in range(k)])
    # the posterior is part of the state, so that it is computed once and not in every step
    start = F.struct(F.lit(1.0).alias("now"), F.lit(1.0).alias("last"), *[p.alias(f"p{d}") for d, p in enumerate(posterior)])
    moves = F.from_json(F.lit(json.dumps([list(map(float, s)) for s in steps])), "array<array<double>>")
    return F.aggregate(moves, start, step, lambda state: state["now"])


def fit_rates(cells: DataFrame, weights: list[float], names: list[str], bounds: tuple[float, float] = BOUNDS,
              max_steps: int = 100, tolerance: float = TOLERANCE) -> tuple[list[tuple[float, ...]], float]:
    """(steps, residual) of the rates over ``cells`` (grid columns ``names``, tokens).

    Targets are ``weights`` of the cells' tokens, over the domains that have any.
    ``residual`` is the largest distance of a domain's total from its target,
    as a share of the tokens.
    """
    posterior, k = _shares(names), len(names)
    row = cells.agg(*[F.sum(F.col("tokens") * p) for p in posterior],
                    *[F.sum(F.col("tokens") * p * q) for p in posterior for q in posterior]).first()
    totals, gram = np.array([x or 0.0 for x in row[:k]]), np.array([x or 0.0 for x in row[k:]]).reshape(k, k)
    size = float(totals.sum())
    share = np.where(totals > 0, weights, 0.0)
    if size == 0 or share.sum() <= 0:
        return [], 0.0
    target = size * share / share.sum()
    metric = np.linalg.inv(gram / size + 1e-9 * np.eye(k)) / size

    def of(steps) -> np.ndarray:
        rate = rate_of(posterior, steps, bounds)
        return np.array([x or 0.0 for x in cells.agg(*[F.sum(rate * F.col("tokens") * p) for p in posterior]).first()])

    def distance(found: np.ndarray) -> float:
        return float((found - target) @ metric @ (found - target))
    steps: list[tuple[float, ...]] = []
    now = last = totals  # totals are linear in the rates, so those of the point ahead follow from two iterates
    best, best_steps = distance(now), 0
    pace = 1.0
    for _ in range(max_steps):
        if np.abs(now - target).max() <= tolerance * size:
            break
        following = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        momentum = (pace - 1) / following
        ahead = now + momentum * (now - last)
        trial = [*steps, (momentum, *(metric @ (ahead - target)).tolist())]
        found = of(trial)
        if distance(found) > distance(now) and momentum > 0:
            pace = 1.0  # the momentum has gone too far: start again from here without it
            last = now
            continue
        moved = np.abs(found - now).max()
        steps, last, now, pace = trial, now, found, following
        if distance(now) < best:
            best, best_steps = distance(now), len(steps)
        if moved <= tolerance / 100 * size:
            break  # nothing is left to gain
    steps = steps[:best_steps]
    return steps, float(np.abs(of(steps) - target).max()) / size


def fit(described: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None,
        bounds: tuple[float, float] = BOUNDS) -> Mixer | None:
    """The mixing of ``described`` (from ``describe``); None where there is no label to learn from."""
    if not 0 <= bounds[0] <= 1 <= bounds[1]:
        raise ValueError("bounds hold 1")
    labelled = described.join(domain_of_labels(labels), F.col("doc_id") == F.col("label_id"))
    pairs = labelled.select("domain", "tokens", F.posexplode("bins").alias("stat", "bin"))
    found = pairs.groupBy("domain", "stat", "bin").agg(F.count("*"), F.sum("tokens")).collect()  # K * STATISTICS * BINS
    counts = {(d, s, b): n for d, s, b, n, _ in found}
    tokens: dict[str, float] = {}
    for d, s, _, n, t in found:
        if s == 0:
            counts[d, -1, 0] = counts.get((d, -1, 0), 0) + n
            tokens[d] = tokens.get(d, 0.0) + t
    weights = tokens if weights is None else weights
    domains = tuple(sorted({k[0] for k in counts} & set(weights)))
    if not domains:
        return None
    names = [f"g_{k}" for k in range(len(domains))]
    member = described.select("tokens", *[p.alias(n) for n, p in zip(names, _posteriors(domains, counts), strict=True)])
    cells = written(member.groupBy(*names).agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "cells")
    steps, residual = fit_rates(cells, [weights[d] for d in domains], names, bounds)
    if residual > TOLERANCE:
        logging.getLogger(__name__).warning("domain targets missed by %.2e of the corpus", residual)
    return Mixer(domains, counts, tuple(steps), bounds, residual)


def _rated(rows: DataFrame, model: Mixer | None) -> DataFrame:
    """``rows`` (with tokens, draw, bins) and g_<k> (grid posterior of domain k), rate and copies."""
    names = [f"g_{k}" for k in range(len(model.domains))] if model else []
    if model:
        rows = rows.withColumns(dict(zip(names, _posteriors(model.domains, model.counts), strict=True)))
    rate = rate_of(_shares(names), model.steps, model.bounds) if model else F.lit(1.0)
    uniform = F.pmod("draw", F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.withColumn("rate", rate).withColumn("copies", F.floor(F.round("rate", 6) + uniform).cast("int"))


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None,
        bounds: tuple[float, float] = BOUNDS) -> DataFrame:
    """doc_id, tokens, p_<domain>, rate, copies of every row of ``docs``, and the residual of the fit."""
    described = describe(docs)
    model = fit(described, labels, weights, bounds)
    shares = _shares([f"g_{k}" for k in range(len(model.domains))]) if model else []
    return _rated(described, model).select(
        "doc_id", "tokens", *[p.alias(f"p_{d}") for p, d in zip(shares, model.domains if model else (), strict=True)],
        "rate", "copies", F.lit(model.residual if model else 0.0).alias("residual"))


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None,
          bounds: tuple[float, float] = BOUNDS) -> DataFrame:
    """The rows of ``docs`` (all columns), each as many times as its rate says."""
    model = fit(describe(docs), labels, weights, bounds)
    plain = [f"c{k}" for k in range(len(docs.columns))]  # names of the input may clash with ours
    doc_id, text = (plain[docs.columns.index(c)] for c in ("doc_id", "text"))
    rows = _rated(docs.toDF(*plain).withColumns(_description(doc_id, text)), model)
    # an outer explode and a filter behind it: one before it would be pushed down and compute the statistics again
    taken = rows.withColumn("copy", F.explode_outer(F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))))
    return taken.where("copy is not null").select(*plain).toDF(*docs.columns)
