"""Personal data by bootstrapped contextual extraction.

Seeds.  Four patterns find the base spans of every whole text: email, ip,
card (16 to 19 digits, Luhn), phone (8 to 15 digits); leftmost and not
overlapping per kind, failing matches are dropped.  They are all kept.

Bootstrapping.  Each span, and each other token that holds a digit or ``@``,
is an instance met in lexical patterns: the one and the two words before it,
and the word before together with the word after it (words within 80 characters
before and 40 after).  Spark holds the graph of patterns and instances (counts of
their meetings) and scores it in ``rounds`` rounds: a pattern's confidence in a kind
is the share of its meetings that are with instances of the kind (seeds count
fully, others by their scores so far, with ``PRIOR`` meetings against it); an instance
that is no seed gets the best confidence among the patterns of at least
``min_confidence`` with at least ``min_seeds`` distinct supporters.  Supporters are the
seeds and, from the second round on, the instances believed by then: so discovered
identifiers induce new patterns, which discover further ones.  Every
occurrence of an instance believed in the end is a span of its kind.

The data path uses DataFrame functions only.  Regular expressions are written
so that each start is tried once (possessive runs), which keeps very long
texts linear.  Meetings are counted before they are joined, so a word pair
that stands before a third of all instances is one row per instance and the
skewed join can be split.

Result, one row per input row: doc_id, n_email, n_ip, n_card, n_phone (base),
base_sha256 and spans: ``kind:start:end`` in code points, end exclusive,
comma-joined by kind, then start.

Defined cases: null and empty texts have no spans; null ids and repeated rows
are rows like others; an empty table gives an empty result.  Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livemart.llm._shared import written

KINDS = ("email", "ip", "card", "phone")
PRIOR = 1.0
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    # a start inside a run of the class could only repeat the run's own match
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OTHER = r"(?<!\S)(?=[^\s0-9@]*+[0-9@])\S++"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IP = rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"


def _luhn(digits: Column) -> Column:
    padded = F.lpad(digits, 20, "0")  # leading zeros add nothing
    total = F.lit(0)
    for place in range(20):
        d = F.substring(padded, 20 - place, 1).cast("int")
        total = total + (d if place % 2 == 0 else d * 2 - F.when(d > 4, 9).otherwise(0))
    return total % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, value, before, after>> of the matches of ``pattern`` in order."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(values)), values,
                       lambda p, v: F.struct(F.length(p).alias("gap"), F.length(v).alias("len")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(pairs, start, lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["len"]).alias("at"),
        F.concat(acc["starts"], F.array(acc["at"] + x["gap"])).alias("starts")))["starts"]
    found = F.transform(starts, lambda s, i: F.struct(
        s.alias("s"), (s + F.length(F.get(values, i))).alias("e"), F.get(values, i).alias("value"),
        F.right(F.get(pieces, i), F.lit(80)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(40)).alias("after")))
    # most texts have no match at all: one look tells
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(
        "array<struct<s:int,e:int,value:string,before:string,after:string>>"))


def _of_kind(text: Column, number: int) -> Column:
    good = F.filter(_matches(text, PATTERNS[KINDS[number]]), lambda m: _holds(KINDS[number], m["value"]))
    return F.transform(good, lambda m: F.struct(
        F.lit(number).alias("kind"), m["s"].alias("s"), m["e"].alias("e"), F.lower(m["value"]).alias("value"),
        m["before"].alias("before"), m["after"].alias("after")))


def _count(spans: str, number: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == number)).cast("long")


def _spans(text: Column) -> Column:
    """All instances of a text: base spans (kind number 0 to 3) and other tokens (null kind)."""
    kinds = [_of_kind(text, number) for number in range(len(KINDS))]
    return F.concat(*kinds)


def _others(text: Column, base: Column) -> Column:
    """Tokens with a digit or ``@`` that touch no base span."""
    free = F.filter(_matches(text, OTHER), lambda m: ~F.exists(base, lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"])))
    return F.transform(free, lambda m: F.struct(
        F.lit(None).cast("int").alias("kind"), m["s"].alias("s"), m["e"].alias("e"), F.lower(m["value"]).alias("value"),
        m["before"].alias("before"), m["after"].alias("after")))


def _contexts(before: Column, after: Column) -> Column:
    """Hashes of the lexical patterns around an instance (none where a word is missing)."""
    one = F.lower(F.regexp_extract(before, r"(\p{L}\S*+)\s*+\z", 1))
    two = F.lower(F.regexp_extract(before, r"(\p{L}\S*+\s++\p{L}\S*+)\s*+\z", 1))
    following = F.lower(F.regexp_extract(after, r"\A[\p{Punct}\s]*+(\p{L}++)", 1))
    return F.array_compact(F.array(
        F.when(one != "", F.xxhash64(F.lit("1"), one)), F.when(two != "", F.xxhash64(F.lit("2"), two)),
        F.when((one != "") & (following != ""), F.xxhash64(F.lit("3"), one, following))))


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(F.array_distinct(spans))
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda x: F.concat(
        F.get(kind, x["kind"]), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def believed_instances(edges: DataFrame, rounds: int, min_confidence: float, min_seeds: int) -> tuple[DataFrame, DataFrame]:
    """(instance, kind) of the discovered instances and (pattern, kind, supporters, confidence) of all
    patterns after the last round, from ``edges`` (pattern, instance, kind, n)."""
    total = written(edges.groupBy("pattern").agg(F.sum("n").alias("total")), "totals")
    open_edges = edges.where("kind is null").select("pattern", "instance", "n")
    support = edges.where("kind is not null").groupBy("pattern", "kind").agg(
        F.sum("n").cast("double").alias("weight"), F.count("*").alias("supporters"))
    support = written(support, "support")

    def scored(support: DataFrame) -> DataFrame:
        found = support.join(total, "pattern").withColumn("confidence", F.col("weight") / (F.col("total") + PRIOR))
        return written(found.select("pattern", "kind", "supporters", "confidence"), "patterns")

    def believed(patterns: DataFrame) -> DataFrame:
        good = patterns.where((F.col("confidence") >= min_confidence) & (F.col("supporters") >= min_seeds))
        best = open_edges.join(good, "pattern").groupBy("instance").agg(
            F.max(F.struct("confidence", (-F.col("kind")).alias("low"))).alias("b"))
        return best.select("instance", (-F.col("b.low")).alias("kind"), F.col("b.confidence").alias("score"))
    patterns = scored(support)
    for _ in range(rounds - 1):
        extra = (open_edges.join(believed(patterns), "instance").groupBy("pattern", "kind")
                 .agg(F.sum(F.col("n") * F.col("score")).alias("weight"), F.count("*").alias("supporters")))
        both = support.unionByName(extra).groupBy("pattern", "kind").agg(
            F.sum("weight").alias("weight"), F.sum("supporters").alias("supporters"))
        patterns = scored(both)
    return believed(patterns).select("instance", "kind"), patterns


def find(docs: DataFrame, rounds: int = 3, min_confidence: float = 0.8, min_seeds: int = 3) -> DataFrame:
    """Base counts, base digest and all spans of every row of ``docs`` (doc_id, text)."""
    text = F.col("text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _spans(text).alias("base"), "text")
    rows = rows.withColumn("other", _others(F.col("text"), F.col("base")))
    instance = F.transform(F.concat("base", "other"), lambda x: F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.xxhash64(x["value"]).alias("instance"),
        _contexts(x["before"], x["after"]).alias("patterns")))
    rows = written(rows.select("doc_id", "row", instance.alias("instances")), "instances")  # slim: no texts
    met = rows.select("row", F.explode("instances").alias("x")).select("row", "x.*")
    meetings = met.select("instance", "kind", F.explode("patterns").alias("pattern"))
    edges = written(meetings.groupBy("pattern", "instance").agg(
        F.min("kind").alias("kind"), F.count("*").alias("n")), "edges")
    known = believed_instances(edges, rounds, min_confidence, min_seeds)[0]
    found = (met.where("kind is null").select("row", "s", "e", "instance").join(known, "instance")
             .groupBy("row").agg(F.collect_list(F.struct("kind", "s", "e")).alias("found")))
    base = F.transform(F.filter("instances", lambda x: x["kind"].isNotNull()),
                       lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    none = F.array().cast("array<struct<kind:int,s:int,e:int>>")
    out = rows.withColumn("base", base).join(found, "row", "left")
    counts = [_count("base", k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                      _joined(F.concat("base", F.coalesce("found", none))).alias("spans"))
