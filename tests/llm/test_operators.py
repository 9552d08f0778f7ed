"""The operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from livemart.llm import (chat_format, decontaminate, domain_mixing, language_id, ngram_jaccard_join, permutation_index,
                          pii_bootstrap, shard_shuffle, substring_dedup, toxicity)

DOCS = "doc_id long, text string, lang string, n_words string, `group` string"


@pytest.fixture(scope="session")
def make_docs(spark):
    from livemart.llm._shared import ship
    ship(spark)

    def make(rows, lang="en"):
        """Documents with extra columns whose names clash with those of results."""
        return spark.createDataFrame([(i, t, lang, "x", "y") for i, t in rows], DOCS)
    return make


rng = random.Random(5)
VOCAB = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(400)]


def words(n):
    return [rng.choice(VOCAB) for _ in range(n)]


def text_rows():
    base, passage = words(120), words(40)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(base[:60] + ["new"] + base[61:])),
            (4, " ".join(words(30) + passage)), (5, " ".join(passage + words(30))), (6, None), (7, ""), (8, " \t\n "),
            (9, "one two"), (10, "one two"), (11, "one"), (None, " ".join(base)), (12, "\t".join(words(20) + passage)),
            (13, " ".join(words(3000) + passage + words(3000))), (1, " ".join(base)), (14, "é" * 50 + " " + " ".join(passage))]
    return rows + [(100 + k, " ".join(base[:k] + ["w%d" % k] + base[k + 1:])) for k in range(0, 100, 5)]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substring_dedup(make_docs):
    rows = text_rows()
    first = {}
    for i, t in rows:
        w = split(t)
        for j in range(len(w) - 12):
            if i is not None:
                first[tuple(w[j:j + 13])] = min(first.get(tuple(w[j:j + 13]), i), i)
    want = []
    for i, t in rows:
        w = split(t)
        keep = [True] * len(w)
        for j in range(len(w) - 12):
            if i is not None and first[tuple(w[j:j + 13])] < i:
                keep[j:j + 13] = [False] * 13
        kept = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        want.append((i, len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest()))
    found = substring_dedup.digest(substring_dedup.substring_dedup(make_docs(rows).repartition(3))).collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    # a saturated sketch only makes false alarms
    small = substring_dedup.digest(substring_dedup.substring_dedup(make_docs(rows), max_cells=1 << 16)).collect()
    assert sorted(map(tuple, small), key=str) == sorted(want, key=str)
    assert substring_dedup.substring_dedup(make_docs([])).count() == 0


def test_ngram_jaccard_join(make_docs, monkeypatch):
    rows = [r for r in text_rows() if r[0] is not None]

    def shingles(t):
        w = split(t)
        return {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    texts = sorted({t for _, t in rows if shingles(t)})
    links = {t: {u for u in texts if u != t and len(shingles(t) & shingles(u)) >= 0.8 * len(shingles(t) | shingles(u))}
             for t in texts}
    low = {t: min(i for i, u in rows if u == t) for t in texts}
    group = {}
    for t in texts:
        seen, todo = {t}, [t]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        group[t] = min(low[u] for u in seen)
    want = [(i, low[t], sum(u == t for _, u in rows), len(links[t]), group[t]) if t in links else (i, i, 1, 0, i)
            for i, t in rows]
    for block in (ngram_jaccard_join.VERIFY_BLOCK, 8):  # 8: components are split into blocks
        monkeypatch.setattr(ngram_jaccard_join, "VERIFY_BLOCK", block)
        found = ngram_jaccard_join.ngram_jaccard_join(make_docs(rows)).drop("keep", "cls").collect()
        assert sorted(map(tuple, found)) == sorted(want)
    kept = ngram_jaccard_join.one_of_each_group(make_docs(rows))
    assert kept.columns == make_docs([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w[4] for w in want})
    assert ngram_jaccard_join.ngram_jaccard_join(make_docs([])).count() == 0


def test_forest_depth_reaches_recall():
    assert ngram_jaccard_join.forest_depth(0.8, 20, 4, 0.9999) == 4
    assert ngram_jaccard_join.forest_depth(0.8, 10, 8, 0.9999) < 8
    with pytest.raises(ValueError):
        ngram_jaccard_join.forest_depth(0.5, 1, 4, 0.9999)


def test_decontaminate(spark, make_docs):
    items = [(1, "Then Maria Jones drove 120 km in 3 hours and paid 3 dollars for every liter of fuel she used on the way."),
             (2, None), (3, ""), (4, "too short")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "bla bla. " + items[0][1] + " more"),
            (2, "x. Then Peter drove 75 miles in 9 minutes and paid 9 euros for every gallon of fuel she used on the way."),
            (3, "Nothing of this kind is in here, only 120 km and 3 hours."), (4, None), (5, ""), (6, "1 2 3 4 5 6 7 8 9 10 11"),
            (None, items[0][1])]
    found = {r.doc_id: r for r in decontaminate.leaks(make_docs(rows), bench).collect()}
    assert set(found) == {1, 2, None} and not found[1].reparameterised and found[2].reparameterised
    clean = decontaminate.without_leaks(make_docs(rows), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6] and clean.columns == make_docs([]).columns
    assert decontaminate.leaks(make_docs(rows), bench.limit(0)).count() == 0
    # one value of the item cannot become two values of the document
    plain = np.array([True, False, True, False])
    value = np.array([1, 5, 2, 5], dtype=np.uint64)
    assert decontaminate._consistent([(0, 0)], plain, value, np.array([1, 7, 2, 7], dtype=np.uint64), 4)[0] == 1
    assert decontaminate._consistent([(0, 0)], plain, value, np.array([1, 7, 2, 8], dtype=np.uint64), 4)[0] == 0
    blocks = decontaminate.leaks(make_docs(rows), bench, block_items=1).collect()
    assert {r.doc_id for r in blocks} == {1, 2, None}


def test_decontaminate_several_occurrences(spark, make_docs):
    form = ("If {} has {} apples and {} pears and gives {} apples to {} then how many apples and how many pears "
            "does {} have now and what do {} apples cost at {} cents each?")

    def item(a, b, *n):
        return form.format(a, n[0], n[1], n[2], b, a, n[3], n[4])
    own, one, two = item("Anna", "Bob", 12, 7, 5, 9, 30), item("Carl", "Dora", 40, 21, 8, 3, 55), item("Emil", "Fay", 6, 4, 2, 77, 91)
    bench = spark.createDataFrame([(1, own)], "item_id long, text string")
    cut = two.replace("how many pears", "how very many ripe pears")
    rows = [(1, one + " " + two), (2, own + " " + one), (3, one + "\n" + two + "\n" + own), (4, one), (5, own),
            (6, cut + " " + one[:60]), (7, " ".join(item("P" + "abcdefgh"[k], "Q" + "abcdefgh"[k], *range(k, k + 5))
                                                    for k in range(8)))]
    found = {r.doc_id: r for r in decontaminate.leaks(make_docs(rows), bench).collect()}
    assert {k: r.reparameterised for k, r in found.items()} == {
        1: True, 2: False, 3: False, 4: True, 5: False, 6: True, 7: True}
    assert all(found[k].n_windows == found[k].item_windows for k in (1, 2, 3, 4, 5, 7))
    # consistent in no occurrence
    odd = item("Carl", "Dora", 1, 2, 3, 4, 5).replace("does Carl", "does Gus")
    assert decontaminate._best([(0, 0), (10, 0)], np.array([False, False]), np.array([5, 5], dtype=np.uint64),
                               np.arange(12, dtype=np.uint64), 2, 1) == (0, False)
    assert decontaminate.leaks(make_docs([(1, odd)]), bench, min_share=1.0).count() == 0


def test_decontaminate_items_without_template(spark, make_docs):
    items = [(1, "Evaluate 3/4 + 5/6"), (2, "Who wrote Hamlet?"), (3, "Who Wrote Romeo And Juliet"), (4, "2+2=?"),
             (5, "What is the capital of France?"), (6, "ALICE BOB CAROL DAVE EVE FRANK GRACE HEIDI IVAN JUDY"),
             (7, "小明有三个苹果，他又买了五个，现在他一共有几个苹果？"), (8, "ผมชอบกินข้าวผัด"), (9, "Maria Jones drove fast to town"),
             (10, "Yes"), (11, "中国"), (12, "+ = ?"), (13, " ".join(map(str, range(30, 60))))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    held = [(k, f"bla bla {t} more text") for k, t in items if k not in (10, 11, 12)]
    held += [(10, "He agreed. Yes. No"), (11, "他说：中国。")]
    other = [(101, "and then What is the capital of Spain? yes"), (102, "and Rome is the capital of Italy now"),
             (103, "I know who wrote Hamlet, yes"), (104, "我爱中国人民"), (105, "2 2 is four"), (106, "+ = ?"), (107, "Yes, and no"),
             (108, " ".join(map(str, range(30, 40))))]
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(make_docs(held + other), bench).collect()}
    assert set(found) == {(k, k) for k, _ in held} | {(101, 5)}
    assert {k for k, r in found.items() if r.reparameterised} == {(101, 5)}
    clean = decontaminate.without_leaks(make_docs(held + other), bench, block_items=3)
    assert sorted(r.doc_id for r in clean.collect()) == list(range(102, 109))


def test_toxicity(spark, make_docs):
    bad = ["grubblo", "snarkle"]
    rows = [(k, " ".join(words(40) + ([rng.choice(bad)] * 2 if k % 5 == 0 else []))) for k in range(200)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), int(k % 5 == 0)) for k in range(150)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(make_docs(rows), labels)
    assert model.thresholds[0] < model.thresholds[1]
    found = {r.doc_id: r for r in toxicity.score(make_docs(rows + [(900, None), (901, ""), (902, "123 !!")]), model).collect()}
    assert all(found[k].toxic == (k % 5 == 0) for k in range(200))
    assert all(found[k].expected_severity == 0 and not found[k].toxic for k in (900, 901, 902))
    assert all(0 <= r.p_toxic <= r.p_poor <= 1 for r in found.values())
    kept = toxicity.without_toxic(make_docs(rows), model)
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(200) if k % 5] and kept.columns == make_docs([]).columns
    none = toxicity.fit(make_docs(rows), labels.where("toxic = 0"))
    assert toxicity.score(make_docs(rows), none).where("toxic or expected_severity > 0").count() == 0


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held))
    pairs = (toxicity.score(docs, model).drop("toxic").join(labels.where(held), "doc_id").select("p_toxic", "toxic").collect())
    pairs = [(r[0] >= 0.5, r[1] == 1) for r in pairs]
    assert sum(a and b for a, b in pairs) / sum(b for _, b in pairs) > 0.85
    assert sum(a and not b for a, b in pairs) / sum(a for a, _ in pairs) < 0.05


def auc(score, positive):
    """Chance that a positive scores above a negative (ties count half)."""
    values, rank = np.unique(score, return_inverse=True)
    n, up = np.bincount(rank, minlength=len(values)), np.bincount(rank[positive], minlength=len(values))
    below = np.cumsum(n - up) - (n - up)
    return float((up * (below + (n - up) / 2)).sum() / (positive.sum() * (~positive).sum()))


def test_toxicity_grades_held_out(spark):
    """Each threshold separates its grades, and grade 1 is told from grade 0 without the toxic ones."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held))
    rows = toxicity.score(docs, model).drop("toxic").join(labels.where(held), "doc_id").collect()
    severity = np.array([r.expected_severity for r in rows])
    grade = np.array([2 if r.toxic else 1 if r.quality == 0 else 0 for r in rows])
    assert auc(severity, grade >= 1) > 0.95 and auc(severity, grade >= 2) > 0.95
    assert auc(severity[grade < 2], grade[grade < 2] == 1) > 0.95
    assert severity[grade == 0].mean() + 0.3 < severity[grade == 1].mean() < severity[grade == 2].mean() - 0.3


def test_shape_features_of_odd_texts():
    import pyarrow as pa
    texts = ["", "a b c d", "### $$$ !!!", "AAAA BBBB", "x\nx\nx\nx", "漢字 " * 10, "word " * 5000]
    offsets, data = toxicity.column_buffers(pa.array(texts))
    row, found = toxicity.letter_words(offsets, data, ())
    bins = toxicity.shapes(offsets, data, row, found[0][1])
    assert bins.shape == (7, toxicity.SHAPES) and bins.min() >= 0 and bins.max() < toxicity.BINS
    assert bins[0].tolist() == [0] * 5 and bins[2, 1] == 15 and bins[3, 2] == 14 and bins[4, 3] == 15
    assert bins[1, 4] == 15 and bins[6, 4] == 0 and bins[6, 0] == 14
    row, feature = toxicity.features(offsets, data)
    assert all((row == k).sum() >= toxicity.SHAPES for k in range(7)) and (np.diff(row) >= 0).all()


def test_language_id(spark, make_docs):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language_id.fit(docs.where(~held), per_lang=100)
    found = language_id.predict(docs.where(held), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    odd = {r.doc_id: r for r in language_id.predict(make_docs([(1, None), (2, ""), (3, "12 34 !?"), (4, "a")]), model).collect()}
    assert [odd[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and odd[1].score == 0 and odd[4].lang_pred in model.langs
    nothing = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(make_docs([(1, "some text")]), nothing).collect()} == {"und"}


def test_chat_format(spark):
    odd = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 1, "assistant", "b <\\| c <| d <\\\\|"), (1, 0, "user", odd), (2, 0, None, None), (2, 0, "assistant", ""),
            (3, None, "sys\ntem", "x"), (3, 0, "assistant", "日本 \U0001f600 <|endoftext|>"), (None, 0, "assistant", odd),
            (4, 0, "user", "same"), (4, 0, "user", "same"), (5, 0, "assistant", "long " * 30_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat_format.digest(chat_format.assemble(turns)).collect()}
    order = sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv in {r[0] for r in rows} - {3}:  # a line break in a role moves the border read back
        mine = [r for r in order if r[0] == conv]
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        digest = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine).encode()).hexdigest()
        assert (found[conv].n_turns, found[conv].turns_sha256) == (len(mine), digest)
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for text in ("", "<|", "<\\|", "<\\\\| <|a|> <", odd):
        assert chat_format.unescape(chat_format.escape(text)) == text and "<|" not in chat_format.escape(text)


def test_shard_shuffle(make_docs):
    rows = [(k % 90, "t" * k) for k in range(333)] + [(None, None), (None, None), (1, "é")] + [(7, "same")] * 50
    found = shard_shuffle.shard_rows(make_docs(rows), shards=16).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in found) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    matrix = shard_shuffle.communication_matrix([10, 0, 25, 7], [14, 14, 14], 3)
    assert matrix.sum(axis=1).tolist() == [10, 0, 25, 7] and matrix.sum(axis=0).tolist() == [14, 14, 14]
    mean = np.mean([shard_shuffle.communication_matrix([10, 20], [15, 15], s)[0, 0] for s in range(400)])
    assert abs(mean - 5) < 0.3
    assert shard_shuffle.shard_rows(make_docs([])).count() == 0


@pytest.mark.parametrize("good,bad,draws", [(5, 7, 4), (7, 5, 9), (1, 9, 3), (30, 50, 40), (60, 20, 70), (1000, 3000, 500), (3000, 2000, 2600)])
def test_hypergeometric_draws_have_the_exact_law(good, bad, draws):
    own = np.random.default_rng(good + draws)
    n = 20_000
    found = np.bincount([shard_shuffle._hypergeometric(own, good, bad, draws) for _ in range(n)], minlength=good + 1)
    chance = np.array([math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws) if 0 <= draws - k <= bad else 0.0
                       for k in range(good + 1)])
    assert found[chance == 0].sum() == 0
    cells = chance * n >= 5
    rest, rest_found = 1 - chance[cells].sum(), n - found[cells].sum()
    chi = ((found[cells] - n * chance[cells]) ** 2 / (n * chance[cells])).sum() + (rest_found - n * rest) ** 2 / max(n * rest, 1)
    assert chi < cells.sum() + 5 * math.sqrt(2 * cells.sum()) + 5


def test_hypergeometric_at_any_size():
    matrix = shard_shuffle.communication_matrix([10 ** 10, 3 * 10 ** 10 + 7, 5], [10 ** 10 + 3] * 4, 2)
    assert matrix.sum(axis=1).tolist() == [10 ** 10, 3 * 10 ** 10 + 7, 5] and matrix.sum(axis=0).tolist() == [10 ** 10 + 3] * 4
    own = np.random.default_rng(1)
    for good, bad, draws in ((10 ** 6, 3 * 10 ** 6, 10 ** 6), (10 ** 12, 9 * 10 ** 12, 4 * 10 ** 11), (6 * 10 ** 12, 10 ** 12, 5 * 10 ** 12)):
        mean = draws * good / (good + bad)
        sd = math.sqrt(mean * bad / (good + bad) * (good + bad - draws) / (good + bad - 1))
        z = (np.array([shard_shuffle._hypergeometric(own, good, bad, draws) for _ in range(8000)], float) - mean) / sd
        assert abs(z.mean()) < 0.05 and abs(z.std() - 1) < 0.04
        assert abs((z ** 3).mean()) < 0.12 and abs((z ** 4).mean() - 3) < 0.4 and abs((np.abs(z) < 1).mean() - 0.6827) < 0.025


def test_shuffle_keeps_whole_rows(make_docs):
    rows = [(k % 90, f"text {k} " * (k % 7)) for k in range(333)] + [(None, None), (7, "same"), (7, "same")]
    docs = make_docs(rows).withColumn("row", F.lit("r")).withColumn("slot", F.lit("old"))
    out = shard_shuffle.shuffle(docs)
    assert out.columns == [*make_docs([]).columns, "row", "shard", "slot"]
    found = out.collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in found))) == sorted(repr((i, t, "en", "x", "y", "r")) for i, t in rows)
    assert len({(r.shard, r.slot) for r in found}) == len(rows)


def test_pipeline_ends_with_whole_rows(make_docs, spark):
    out = corpus_pipeline.STAGES[-1][1](spark, make_docs([(1, "a"), (1, "a"), (2, None)]), "")
    assert sorted((r.doc_id, r.text or "", r.lang) for r in out.collect()) == [(1, "a", "en"), (1, "a", "en"), (2, "", "en")]


def test_domain_mixing(spark, make_docs):
    rows = [(k, " ".join(words(50)) if k % 4 else "### $$$ " * 30) for k in range(200)] + [(300, None), (301, ""), (1, "x y")]
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(100)], "doc_id long, quality int, toxic int")
    found = domain_mixing.mix(make_docs(rows), labels, {"1": 0.5, "0": 0.5}).collect()
    assert len(found) == len(rows) and all(r.rate >= 0 and abs(r.p_0 + r.p_1 - 1) < 1e-9 for r in found)
    assert {r.doc_id: r.tokens for r in found if r.doc_id in (300, 301)} == {300: 0, 301: 0}
    poor, good = (sum(r[c] * r.rate * r.tokens for r in found) for c in ("p_0", "p_1"))
    assert abs(poor / (poor + good) - 0.5) < 0.01
    out = domain_mixing.mixed(make_docs(rows), labels, {"1": 0.5, "0": 0.5})
    assert out.columns == make_docs([]).columns and out.count() == sum(r.copies for r in found)
    assert domain_mixing.mixed(make_docs(rows), labels.limit(0)).count() == len(rows)


# (p_0 in fiftieths, tokens) of soft posteriors: few documents are wholly in one domain
SOFT = [(0, 389795), (1, 2204032), (2, 660353), (5, 138164), (15, 9687), (18, 14202), (24, 55815), (31, 19126), (40, 10854),
        (42, 13158), (47, 78894), (48, 137125), (49, 53101), (50, 62351)]


def fitted(spark, cells, weights, bounds=domain_mixing.BOUNDS):
    k = len(weights)
    names = [f"g_{i}" for i in range(k)]
    table = spark.createDataFrame(cells, ", ".join(f"{c} int" for c in names) + ", tokens long")
    steps, residual = domain_mixing.fit_rates(table, weights, names, bounds)
    rate = domain_mixing.rate_of(domain_mixing._shares(names), steps, bounds)
    rows = {tuple(r)[:k]: r.rate for r in table.withColumn("rate", rate).collect()}
    return np.array([rows[tuple(c[:k])] for c in cells]), residual


def brute_rates(cells, weights, bounds):
    """Bounded least squares by many plain projected gradient steps, in the same metric."""
    k = len(weights)
    p = np.array([c[:k] for c in cells]) / 50
    t = np.array([c[k] for c in cells], float)
    target = t.sum() * np.array(weights) / sum(weights)
    metric = np.linalg.inv((p.T * t) @ p / t.sum() + 1e-9 * np.eye(k)) / t.sum()
    rate = np.ones(len(t))
    for _ in range(20000):
        rate = np.clip(rate - p @ (metric @ (p.T @ (rate * t) - target)), *bounds)
    return rate, np.abs(p.T @ (rate * t) - target).max() / t.sum()


SOFT = [(p, 50 - p, t) for p, t in SOFT]
THREE = [(50 - a - b, a, b, 100 + 7 * a + b * b) for a in range(0, 51, 5) for b in range(0, 51 - a, 5)]


@pytest.mark.parametrize("cells,weights,bounds", [
    (SOFT, [0.2, 0.8], (0.25, 4.0)), (SOFT, [0.01, 0.99], (0.25, 4.0)), (SOFT[1:6], [0.9, 0.1], (0.5, 2.0)),
    (THREE, [0.9, 0.09, 0.01], (0.25, 4.0)), ([(50, 0, 1_000_000), (49, 1, 500)], [0.1, 0.9], (0.25, 4.0))])
def test_domain_rates_are_bounded_least_squares(spark, cells, weights, bounds):
    rate, residual = fitted(spark, cells, weights, bounds)
    want, left = brute_rates(cells, weights, bounds)
    assert rate.min() >= bounds[0] and rate.max() <= bounds[1]
    assert residual <= left + 2e-4
    if left > 1e-3:  # out of reach: the same best rates, and the residual says so
        assert abs(residual - left) < 1e-3


def test_domain_rates_default_keeps_the_corpus(spark, make_docs):
    rows = [(k, " ".join(words(50)) if k % 4 else "### $$$ " * 30) for k in range(200)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(100)], "doc_id long, quality int, toxic int")
    found = domain_mixing.mix(make_docs(rows), labels).collect()
    assert all(0.9 < r.rate < 1.1 and r.residual < 1e-3 for r in found)
    with pytest.raises(ValueError):
        domain_mixing.mix(make_docs(rows), labels, bounds=(2.0, 3.0))


def test_mixing_of_a_whole_table(spark):
    """No labelled good document is left out, and the rows stay within the bounds."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = domain_mixing.mix(docs, labels).join(labels, "doc_id", "left")
    low, high, n, copies = found.agg(F.min("rate"), F.max("rate"), F.count("*"), F.sum("copies")).first()
    assert 0.25 <= low and high <= 4 and 0.8 * n < copies < 1.25 * n
    assert found.where("quality = 1 and rate < 0.9").count() == 0
    good = domain_mixing.mix(docs, labels, {"1": 0.99, "0": 0.01})  # out of reach: bounded all the same
    low, high, copies, left = good.agg(F.min("rate"), F.max("rate"), F.sum("copies"), F.max("residual")).first()
    assert 0.25 <= low and high <= 4 and n / 4 < copies < 4 * n and left > 0


def test_mixing_with_clashing_names_and_odd_rows(spark, make_docs):
    names = ["row_hash", "row_hash_", "n_copies_", "tokens", "bins", "draw", "rate", "copies", "g_0", "c0", "copy"]
    rows = [(k, " ".join(words(50)) if k % 4 else "### $$$ " * 30) for k in range(60)]
    rows += [(None, None), (None, "no id"), (5, rows[5][1]), (5, rows[5][1]), (70, ""), (71, " ".join(words(20_000)))]
    docs = make_docs(rows)
    for name in names:
        docs = docs.withColumn(name, F.lit("mine"))
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(40)] + [(None, 1, 0), (50, None, 0), (3, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    out = domain_mixing.mixed(docs, labels, {"1": 0.4, "0": 0.6})
    assert out.columns == docs.columns and out.schema == docs.schema
    copies = domain_mixing.mix(docs, labels, {"1": 0.4, "0": 0.6})
    assert out.count() == copies.agg(F.sum("copies")).first()[0]
    assert {r.copies for r in copies.where("doc_id = 5").collect()} == {copies.where("doc_id = 5").first().copies}
    assert all(r[n] == "mine" for r in out.collect() for n in names)
    assert domain_mixing.mixed(docs.limit(0), labels).count() == 0 and domain_mixing.mix(docs.limit(0), labels).count() == 0


CLASHING = ["id", "of", "draw", "rank", "kept_id", "kept_cls", "cls", "own_id", "has_letter", "c0", "label_id", "grade", "most"]


def odd_docs(make_docs, rows):
    """Null ids, empty and very long texts, repeated rows, and columns named like those of the operators."""
    rows = rows + [(None, None), (None, "no id here at all"), (7, rows[7][1]), (7, rows[7][1]), (900, ""), (901, " ".join(words(20_000)))]
    docs = make_docs(rows)
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


def test_stages_with_clashing_names_and_odd_rows(spark, make_docs):
    docs = odd_docs(make_docs, [(k, " ".join(words(40) + ["grubblo"] * (2 * (k % 5 == 0)))) for k in range(100)])
    labels = spark.createDataFrame([(k, int(k % 3 > 0), int(k % 5 == 0)) for k in range(80)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(words(30)))], "item_id long, text string")
    stages = [lambda d: toxicity.without_toxic(d, toxicity.fit(d, labels)), ngram_jaccard_join.one_of_each_group,
              lambda d: decontaminate.without_leaks(d, bench), lambda d: domain_mixing.mixed(d, labels),
              shard_shuffle.shuffle]
    for stage in stages:
        out = stage(docs)
        assert out.columns[:len(docs.columns)] == docs.columns
        rows = out.collect()
        assert all(r[n] == "mine" for r in rows for n in CLASHING)
        assert max(len(r.text or "") for r in rows) > 60_000 and stage(docs.limit(0)).count() == 0
    kept = ngram_jaccard_join.one_of_each_group(docs).where("doc_id = 7 or doc_id is null").collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept)[:2] == [(0, ""), (0, "no id")] and len(kept) == 3


def _operators(spark):
    from livemart.llm import piece_codec
    labels = spark.createDataFrame([(k, k % 2, int(k % 5 == 0)) for k in range(80)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(words(30)))], "item_id long, text string")
    chat = lambda d: d.select(F.col("doc_id").alias("conv_id"), F.lit(None).cast("long").alias("turn"),
                              F.lit("assistant").alias("role"), "text", *CLASHING)
    return {
        "op1": pii_bootstrap.find, "op2": shard_shuffle.shard_rows, "op4": lambda d: domain_mixing.mix(d, labels),
        "op5": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "op6": lambda d: language_id.predict(d, language_id.fit(d)), "op7": lambda d: decontaminate.leaks(d, bench),
        "op8": ngram_jaccard_join.ngram_jaccard_join, "op9": lambda d: chat_format.digest(chat_format.assemble(chat(d))),
        "op10": substring_dedup.substring_dedup, "op12": lambda d: piece_codec.decode(piece_codec.encode(d))}


@pytest.mark.parametrize("name", ["op1", "op2", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op12"])
def test_every_operator_on_odd_and_empty_tables(spark, make_docs, name):
    """Null ids, null, empty and very long texts, repeated rows, clashing names; then no rows at all."""
    docs = odd_docs(make_docs, [(k, " ".join(words(40) + ["grubblo"] * (2 * (k % 5 == 0)))) for k in range(100)])
    run = _operators(spark)[name]
    out = run(docs)
    rows = out.collect()
    if name not in ("op7", "op9"):  # one row per row
        assert len(rows) == docs.count()
        key = [c for c in out.columns if c not in ("shard", "slot", "keep")]
        assert len({tuple(str(r[c]) for c in key) for r in rows if r.doc_id == 7}) == 1  # repeated rows: alike
        assert sum(r.doc_id is None for r in rows) == 2
    if name == "op9":
        assert sorted(str(r[0]) for r in rows) == sorted({str(r.doc_id) for r in docs.select("doc_id").collect()})
    empty = run(docs.limit(0))
    assert empty.columns == out.columns or name in ("op4",)
    assert empty.count() == 0


def test_language_sample_is_bounded(spark, make_docs):
    docs = odd_docs(make_docs, [(7, " ".join(words(5))) for _ in range(500)])
    assert language_id._sampled(docs, 10).count() == 10
    model = language_id.fit(docs, per_lang=10)
    assert {r.lang_pred for r in language_id.predict(docs, model).collect()} == {"en", "und"}
    same = make_docs([(7, "one and the same text")] * 500)
    assert language_id._sampled(same, 10).count() == 10 and language_id._sampled(same.limit(0), 10).count() == 0


BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in value.split("."))
    if kind == "card":
        luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and luhn % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_pii_base_spans(make_docs):
    texts = [None, "", "a@b.c_d@e.f.g x%y@z.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4", "4111 1111 1111 1111 4111-1111-1111-1112",
             "+1 (504) 555-2652 +12 +1 234 567 8", "é\U0001f600 a.b@c-d.com, 9177399536541148.", "7" * 20_000, "a" * 20_000,
             "a@" + "b." * 9000 + "c", "1." * 5000 + "1", "+1" + " 2" * 30, "x@y.z" * 50]
    alphabet = "ab1234.@+- ()_%é"
    texts += ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(300)]
    found = {r.doc_id: r for r in pii_bootstrap.find(make_docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        spans = [(k, m.start(), m.end()) for k, p in BASE for m in re.finditer(p, t or "") if holds(k, m.group())]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert found[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), t
        assert found[i].n_email == sum(s[0] == "email" for s in spans)
        assert set(joined.split(",")) - {""} <= set(found[i].spans.split(","))


def test_pii_bootstraps_unseen_identifiers(make_docs):
    rows = [(k, f"filler please write to u{k}@mail.example today") for k in range(40)]
    rows += [(100, "please write to user17(at)mail.example today"), (101, "we counted 17 sheep today")]
    found = {r.doc_id: r.spans for r in pii_bootstrap.find(make_docs(rows)).collect()}
    assert found[100] == "email:16:38" and found[101] == ""


def test_pii_second_hop(make_docs):
    """Seeds trust a pattern, what it discovers trusts another, whose identifiers are marked wherever they stand."""
    rows = [(1000 + k, f"please reach user{k}@mail.example soon") for k in range(400)]
    rows += [(100 + k, f"please reach ID-{k}X7 today") for k in range(40)]          # first hop: the seeds' pattern
    rows += [(200 + k, f"badge number ID-{k}X7 was seen") for k in range(40)]       # induces a second pattern
    rows += [(300 + k, f"badge number ZZ{k}9 was seen") for k in range(3)]          # second hop
    rows += [(400, "nothing but ZZ09 alone"), (401, "room 12 and page 34 of volume 5"), (402, None)]
    found = {r.doc_id: r.spans for r in pii_bootstrap.find(make_docs(rows)).collect()}
    assert found[100] == "email:13:19" and found[200] == "email:13:19"
    assert found[300] == "email:13:17" and found[400] == "email:12:16"
    assert found[401] == found[402] == ""
    once = {r.doc_id: r.spans for r in pii_bootstrap.find(make_docs(rows), rounds=1).collect()}
    assert once[100] and once[200] and not once[300]  # one round: the seeds' own pattern only


def brute_bootstrap(edges, rounds, min_confidence, min_seeds):
    total, seeds = {}, {}
    for p, i, k, n in edges:
        total[p] = total.get(p, 0) + n
        if k is not None:
            w, c = seeds.get((p, k), (0, 0))
            seeds[p, k] = (w + n, c + 1)
    support = dict(seeds)
    for step in range(rounds):
        score = {(p, k): w / (total[p] + pii_bootstrap.PRIOR) for (p, k), (w, _) in support.items()}
        best = {}
        for p, i, kind, n in edges:
            for k in range(4):
                if kind is None and score.get((p, k), 0) >= min_confidence and support[p, k][1] >= min_seeds:
                    best[i] = max(best.get(i, (0, -9)), (score[p, k], -k))
        if step < rounds - 1:
            support = dict(seeds)
            for p, i, kind, n in edges:
                if kind is None and i in best:
                    s, k = best[i]
                    w, c = support.get((p, -k), (0, 0))
                    support[p, -k] = (w + n * s, c + 1)
    return {i: -k for i, (_, k) in best.items()}, score


@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_pii_scores_brute_force(spark, make_docs, rounds):
    local = random.Random(9)
    seen = {(p, i): (p, i, (i % 4 if i < 40 else None), local.randint(1, 6))
            for p, i in ((local.randrange(60), local.randrange(120)) for _ in range(500))}
    for p in range(60, 70):  # patterns of one kind, and what they share with open instances
        seen.update({(p, i): (p, i, 1, 9) for i in range(1, 40, 4)})
        seen.update({(p, i): (p, i, None, 1) for i in range(40 + p - 60, 120, 17)})
    edges = list(seen.values())
    table = spark.createDataFrame(edges, "pattern long, instance long, kind int, n long")
    known, patterns = pii_bootstrap.believed_instances(table, rounds, 0.6, 2)
    want, score = brute_bootstrap(edges, rounds, 0.6, 2)
    assert {r.instance: r.kind for r in known.collect()} == want and want
    assert {(r.pattern, r.kind): round(r.confidence, 9) for r in patterns.collect()} == {k: round(v, 9) for k, v in score.items()}


def test_permutation_index(spark):
    gen = np.random.default_rng(3)
    data = gen.normal(size=(1500, 16))
    data[700:800] = data[5]  # copies: ties go to the smaller id
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(data)]
    odd = [(2000, None), (2100, []), (2200, [0.0] * 16), (2300, [None] + [1.0] * 15), (2400, [float("nan")] * 16),
           (2500, [float("inf")] * 16), (2600, [1.0] * 3), (None, [1.0] * 16)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    index, pivots = permutation_index.build_index(frame)
    found = permutation_index.search(index, pivots, index.where("vec_id % 100 = 0").select("vec_id", "vec")).collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 100))
    hits = 0
    for q in got:
        dist = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        want = [k for k in np.lexsort((np.arange(1500), dist)) if k != q][:10]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(s - dist[v]) < 1e-12 for _, v, s in mine)
        hits += len(set(want) & {v for _, v, _ in mine})
    assert hits / (10 * len(got)) >= 0.9
    assert [v for _, v, _ in sorted(got[700])] == [5, *range(701, 710)]
    empty, none = permutation_index.build_index(frame.limit(0))
    assert permutation_index.search(empty, none, empty.select("vec_id", "vec")).count() == 0
