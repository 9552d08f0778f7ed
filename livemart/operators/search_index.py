"""Inverted index over sale names: term -> postings, all-terms match, facets and BM25 order.

F8, A11-A15, L2, Q4-Q6 (SRC7).  Postings are one row per (term, sale line):
day, line id, how often the term stands in the name, the name's length, and
the columns the facets count.  They are written in ranges of (term, day, id), so a
search reads the row groups of its own terms and day, and a term that most
lines have is spread over as many files as it needs.  A table of terms
(document frequency) and one row for the collection (lines, tokens) serve the
relevance order.

A search is an aggregate over the postings of its terms: a line matches when
it has all of them.  Facets are counted on the matches without reading a sale
row; only the rows of the page are fetched, by id.

BM25 (relevance of a term t in a line): idf(t) * tf * (K1 + 1) / (tf + K1 *
(1 - B + B * length / average length)), idf(t) = ln(1 + (n - df + 0.5) /
(df + 0.5)), over all lines that have a name; scores are rounded to nine
places so that ties are ties, and go to the smaller id.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livemart.functions.text import query_terms, tokens
from livemart.operators import search
from livemart.passes import drop_folder, in_ranges, shuffles_removed

# The usual BM25 parameters (term saturation, length weight).
K1 = 1.2
B = 0.75
FACET_COLUMNS = ("user_gender", "user_age", "user_level")
# what the index reads of a sale row
INDEXED_COLUMNS = ("dt", "order_detail_id", "sku_name", *FACET_COLUMNS)


def postings(sales: DataFrame, *more: str) -> DataFrame:
    """(term, dt, order_detail_id, tf, length, facet columns) of every line; no shuffle.

    ``more`` may name ``first``: whether the entry is the first one of its line.
    """
    named = sales.withColumn("_tokens", F.coalesce(tokens("sku_name"), F.array().cast("array<string>")))
    entry = F.transform(F.array_distinct("_tokens"), lambda t: F.struct(
        t.alias("term"), F.size(F.filter("_tokens", lambda x: x == t)).alias("tf")))
    rows = named.select("dt", "order_detail_id", F.size("_tokens").alias("length"), *FACET_COLUMNS,
                        F.posexplode(entry).alias("_pos", "e")).withColumn("first", F.col("_pos") == 0)
    return rows.select("e.term", "dt", "order_detail_id", "e.tf", "length", *FACET_COLUMNS, *more)


class SaleIndex:
    """The index at ``path``: ``postings``, ``terms`` and ``collection``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def build(cls, sales: DataFrame, path: str) -> "SaleIndex":
        index = cls(sales.sparkSession, path)
        order, stage = ["term", "dt", "order_detail_id"], f"{index.path}/staged"
        with shuffles_removed(index.spark):
            # computed once and stored as it comes: the ranges, a pass each, and the collection read it
            postings(sales.select(*INDEXED_COLUMNS), "first").write.mode("overwrite").option("compression", "zstd").parquet(stage)
            staged = index.spark.read.parquet(stage)
            for k, part in enumerate(in_ranges(staged.drop("first"), order, staged.count())):
                (part.repartitionByRange(*order).sortWithinPartitions(*order)
                 .write.mode("append" if k else "error").option("compression", "zstd").parquet(f"{index.path}/postings"))
            staged.where("first").agg(
                F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("tokens")) \
                .write.parquet(f"{index.path}/collection")
            held = index.postings()
            (held.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))
             .repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{index.path}/terms"))
        drop_folder(index.spark, stage)
        return index

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings")

    def terms_of(self, keyword: str) -> list[str]:
        """The distinct terms of a keyword."""
        return self.spark.range(1).select(query_terms(keyword).alias("t")).first()["t"]

    def matches(self, keyword: str, date: str | None = None, level: str | None = None) -> DataFrame:
        """(order_detail_id, dt, facet columns, score, bm25) of the lines that have every term.

        ``score`` is the plain number of hits (as ``search.search``).  No term, no match.
        """
        terms = self.terms_of(keyword)
        held = self.postings().where(F.col("term").isin(terms) if terms else F.lit(False))
        if date is not None:
            held = held.where(F.col("dt") == date)
        if level is not None:
            held = held.where(F.col("user_level") == level)
        lines = held.groupBy("order_detail_id", "dt", *FACET_COLUMNS).agg(
            F.count(F.lit(1)).alias("_terms"), F.sum("tf").cast("int").alias("score"),
            F.round(F.sum(self._relevance(terms)), 9).alias("bm25"))
        return lines.where(F.col("_terms") == len(terms)).drop("_terms")

    def _relevance(self, terms: list[str]):
        if not terms:
            return F.lit(0.0)
        size = self.spark.read.parquet(f"{self.path}/collection").first()
        held = self.spark.read.parquet(f"{self.path}/terms").where(F.col("term").isin(terms))
        df = {r["term"]: r["df"] for r in held.collect()}  # one row a term of the keyword
        n, average = size["lines"], size["tokens"] / max(size["lines"], 1)
        idf = F.create_map(*[F.lit(x) for t in terms for x in (
            t, math.log(1 + (n - df.get(t, 0) + 0.5) / (df.get(t, 0) + 0.5)))])
        length = K1 * (1 - B + B * F.col("length") / F.lit(float(average or 1)))
        return idf[F.col("term")] * F.col("tf") * (K1 + 1) / (F.col("tf") + length)

    def page(self, matched: DataFrame, sales: DataFrame, page_no: int, size: int, by: str = "score") -> DataFrame:
        """The sale rows of one page of ``matched``, best ``by`` first, then by id, with that score.

        ``sales`` should be cut to the day: its rows are joined to the page's
        ids (at most ``size``, a broadcast of that bound).
        """
        top = search.page(matched.select("order_detail_id", F.col(by).alias("score")), page_no, size)
        return sales.join(F.broadcast(top), "order_detail_id")

    def result(self, sales: DataFrame, keyword: str, date: str, page_no: int, size: int) -> DataFrame:
        """Q4-Q6 as one nested row: facets and total from the postings, the page's rows from ``sales``."""
        matched = self.matches(keyword, date)
        rows = self.page(matched, sales, page_no, size).select(*sales.columns, "score")
        return search.result(matched, page_no, size, rows)
