"""Sale search: term filter, all-terms text match, paging and facets.

F7, F8, L1-L3, L5, A11-A15, A19.  A search reads one filtered DataFrame;
every facet is a map-side-combined aggregate over it, and the post-aggregate
steps touch at most a few hundred rows (distinct genders / ages).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemart.functions.numeric import percent_1dp
from livemart.functions.shape import (AGE_BAND_LABELS, AGE_GROUP_TITLE, GENDER_GROUP_TITLE,
                                      GENDER_LABELS, age_band, option)
from livemart.functions.text import matches_all, query_terms, term_hits, tokens

# Bucket counts of the two terms facets of the sale search.
GENDER_TOP = 2
AGE_TOP = 100


def search(sales: DataFrame, date: str | None, keyword: str, level: str | None = None) -> DataFrame:
    """F7 + F8 (+ F11): rows of day ``date`` whose ``sku_name`` holds every keyword term.

    Adds ``score`` (how many name tokens are query terms) for the default
    relevance order.  The date test is a plain equality, pushed to the scan
    (a partition filter on a table stored by ``dt``).  ``level`` optionally
    restricts to one user level (the dashboard sends it; off by default).
    """
    if date is not None:
        sales = sales.where(F.col("dt") == date)
    if level is not None:
        sales = sales.where(F.col("user_level") == level)
    terms = query_terms(keyword)
    toks = tokens("sku_name")
    return (sales.where(matches_all(toks, terms))
                 .withColumn("score", term_hits(toks, terms)))


def page(matched: DataFrame, page_no: int, size: int) -> DataFrame:
    """L1 + L2: one page, relevance first, then ``order_detail_id`` (a total order).

    ``orderBy().offset().limit()`` plans as a top-k: each task keeps its best
    ``page_no * size`` rows, so no full sort of the matches.
    """
    start = max(page_no - 1, 0) * size
    ordered = matched.orderBy(F.col("score").desc(), F.col("order_detail_id"))
    return ordered.offset(start).limit(size) if start else ordered.limit(size)


def page_from_offset(start_row: int, size: int) -> int:
    """A table widget's row offset -> 1-based page number."""
    return start_row // size + 1 if size > 0 else 1


def total(matched: DataFrame) -> DataFrame:
    """Number of hits: (total)."""
    return matched.agg(F.count(F.lit(1)).alias("total"))


def terms_facet(matched: DataFrame, column: str, k: int) -> DataFrame:
    """A11/A12 + L3: the ``k`` most frequent non-null values: (value, cnt).

    Ties are broken by the value so the cut is deterministic.
    """
    counts = matched.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.col("cnt").desc(), F.col(column)).limit(k)


def _gender_group(matched: DataFrame) -> DataFrame:
    """One row: the gender option group, ``struct<title, options>`` (male, female)."""
    agg = matched.agg(F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col("user_gender") == "M").alias("m"),
                      F.count_if(F.col("user_gender") == "F").alias("f"))
    pct = lambda c: F.coalesce(percent_1dp(c, "n"), F.lit(0.0).cast("double"))
    opts = F.array(option(GENDER_LABELS["M"], pct("m")), option(GENDER_LABELS["F"], pct("f")))
    return agg.select(F.struct(F.lit(GENDER_GROUP_TITLE).alias("title"), opts.alias("options")).alias("g"))


def _age_group(matched: DataFrame) -> DataFrame:
    """One row: the age-band option group, ``struct<title, options>`` (three bands).

    The bands re-aggregate the counts of all ages, so they add up to all
    hits (``AGE_TOP`` is the cut of the age list, A12, only).
    """
    ages = matched.groupBy("user_age").agg(F.count(F.lit(1)).alias("cnt"))
    band = age_band("user_age")
    agg = ages.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"),
                   *[F.coalesce(F.sum(F.when(band == b, F.col("cnt"))), F.lit(0)).alias(f"b{i}")
                     for i, b in enumerate(AGE_BAND_LABELS)])
    pct = lambda c: F.coalesce(percent_1dp(c, "n"), F.lit(0.0).cast("double"))
    opts = F.array(*[option(b, pct(f"b{i}")) for i, b in enumerate(AGE_BAND_LABELS)])
    return agg.select(F.struct(F.lit(AGE_GROUP_TITLE).alias("title"), opts.alias("options")).alias("a"))


def _rows(group: DataFrame, col: str) -> DataFrame:
    return (group.select(F.explode(f"{col}.options").alias("o"), F.col(f"{col}.title").alias("title"))
                 .select("title", "o.name", "o.value"))


def gender_share(matched: DataFrame) -> DataFrame:
    """Q5 (A11 + A15 + P17): percent of hits per gender: (title, name, value).

    One aggregate row with the total and both gender counts, then two rows.
    A gender absent from the hits gets 0.0 (the upstream code failed there).
    """
    return _rows(_gender_group(matched), "g")


def age_share(matched: DataFrame) -> DataFrame:
    """Q6 (A12 + A14 + A15): percent of hits per age band: (title, name, value)."""
    return _rows(_age_group(matched), "a")


def stat(matched: DataFrame) -> DataFrame:
    """One row: ``stat`` = [gender group, age group] (P20 option groups, in that order)."""
    both = _gender_group(matched).unionByName(_age_group(matched), allowMissingColumns=True)
    folded = both.agg(F.first("g", ignorenulls=True).alias("g"), F.first("a", ignorenulls=True).alias("a"))
    return folded.select(F.array("g", "a").alias("stat"))


def detail(matched: DataFrame, page_no: int, size: int) -> DataFrame:
    """One row: ``detail`` = the page's rows in page order (at most ``size`` of them)."""
    cols = [c for c in matched.columns if c != "score"]
    packed = F.struct((-F.col("score")).alias("k1"), F.col("order_detail_id").alias("k2"),
                      F.struct(*cols).alias("row"))
    return page(matched, page_no, size).agg(
        F.transform(F.array_sort(F.collect_list(packed)), lambda x: x["row"]).alias("detail"))


def facets(matched: DataFrame) -> DataFrame:
    """Gender counts, age-band counts and the total in one pass.

    ``GROUPING SETS ((user_gender), (age_band), ())``; null genders are not a
    gender bucket.  Output: (facet, key, cnt).
    """
    banded = matched.select("user_gender", age_band("user_age").alias("age_band"))
    g = banded.groupingSets([["user_gender"], ["age_band"], []], "user_gender", "age_band").agg(
        F.count(F.lit(1)).alias("cnt"), F.grouping_id().alias("gid"))
    facet = (F.when(F.col("gid") == 1, F.lit("gender"))
              .when(F.col("gid") == 2, F.lit("age_band"))
              .otherwise(F.lit("total")))
    key = F.when(F.col("gid") == 1, F.col("user_gender")).when(F.col("gid") == 2, F.col("age_band"))
    out = g.select(facet.alias("facet"), key.alias("key"), "cnt")
    return out.where(~((F.col("facet") == "gender") & F.col("key").isNull()))


def _counts(matched: DataFrame) -> DataFrame:
    """One pass over the hits: counts per gender, per age, and in total.

    ``GROUPING SETS ((user_gender), (user_age), ())``: at most (genders +
    ages + 1) rows, from which every facet of a response is derived.
    """
    return (matched.groupingSets([["user_gender"], ["user_age"], []], "user_gender", "user_age")
                   .agg(F.count(F.lit(1)).alias("cnt"), F.grouping_id().alias("gid")))


def result(matched: DataFrame, page_no: int, size: int, rows: DataFrame | None = None) -> DataFrame:
    """Q4-Q6 as one nested row: total, stat (option groups) and the detail page.

    ``rows``: the page's rows if they are already there (an index has them by id).

    A19: the hits are read twice -- once for all counts (one grouping-sets
    aggregate; every facet is derived from its few rows, whose shuffle is
    reused) and once for the page (a top-k).  The one-row parts are stacked
    and folded with ``first(ignorenulls)`` (no join); the detail array holds
    one page, so the row stays bounded whatever the number of hits.
    """
    c = _counts(matched)
    n = c.where(F.col("gid") == 3).select(F.col("cnt").alias("n"))
    genders = c.where(F.col("gid") == 1).agg(
        F.coalesce(F.sum(F.when(F.col("user_gender") == "M", F.col("cnt"))), F.lit(0)).alias("m"),
        F.coalesce(F.sum(F.when(F.col("user_gender") == "F", F.col("cnt"))), F.lit(0)).alias("f"))
    band = age_band("user_age")
    bands = c.where(F.col("gid") == 2).agg(*[F.coalesce(F.sum(F.when(band == b, F.col("cnt"))), F.lit(0)).alias(f"b{i}")
                      for i, b in enumerate(AGE_BAND_LABELS)])
    parts = n.unionByName(genders, allowMissingColumns=True).unionByName(bands, allowMissingColumns=True)
    one = parts.agg(*[F.first(x, ignorenulls=True).alias(x) for x in ("n", "m", "f", "b0", "b1", "b2")])
    pct = lambda x: F.coalesce(percent_1dp(x, "n"), F.lit(0.0).cast("double"))
    gender_group = F.struct(F.lit(GENDER_GROUP_TITLE).alias("title"), F.array(
        option(GENDER_LABELS["M"], pct("m")), option(GENDER_LABELS["F"], pct("f"))).alias("options"))
    age_group = F.struct(F.lit(AGE_GROUP_TITLE).alias("title"), F.array(
        *[option(b, pct(f"b{i}")) for i, b in enumerate(AGE_BAND_LABELS)]).alias("options"))
    head = one.select(F.coalesce("n", F.lit(0)).alias("total"), F.array(gender_group, age_group).alias("stat"))
    page_rows = detail(matched, page_no, size) if rows is None else detail(rows, 1, size)
    stacked = head.unionByName(page_rows, allowMissingColumns=True)
    return stacked.agg(*[F.first(x, ignorenulls=True).alias(x) for x in ("total", "stat", "detail")])
