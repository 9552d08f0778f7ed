"""Whitening, piece codec and hard negatives against brute force and the library."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from livemart.llm import bond_negatives, piece_codec, whitening
from livemart.llm._shared import ship

VECTORS = "vec_id long, embedding array<float>, label int, x string, rank string, good string, score string"


@pytest.fixture(scope="module")
def vectors(spark):
    ship(spark)
    return lambda rows: spark.createDataFrame([(i, v, lab, "a", "b", "c", "d") for i, v, lab in rows], VECTORS)


rng = np.random.default_rng(3)


def vector_rows(n=400, d=12, labels=5):
    centres = rng.normal(size=(labels, d))
    rows = []
    for i in range(n):
        lab = int(rng.integers(labels))
        rows.append((i, [float(c) for c in (centres[lab] + rng.normal(size=d) / 2).astype(np.float32)], lab))
    rows += [(1000 + k, list(rows[k][1]), rows[k][2]) for k in range(30)]  # copies under other ids: ties
    rows += [rows[5], rows[100], (100, rows[7][1], 3)]  # repeated ids
    rows += [(2000, None, 1), (2001, [], 1), (2002, [float("nan")] * d, 1), (2003, [None] + [1.0] * (d - 1), 2),
             (2004, [float("inf")] * d, 2), (2005, [1.0] * (d + 1), 2), (2006, [0.0] * d, 2), (2007, [-0.0] * d, None)]
    return rows


def taking(rows, d=12):
    return [(i, [int(np.floor(256 * float(c))) for c in v], lab) for i, v, lab in rows
            if v and len(v) == d and all(c is not None and np.isfinite(c) for c in v)]


def brute_negatives(rows, positives=5, negatives=10):
    rows = [r for r in taking(rows) if r[0] is not None and r[2] is not None]
    anchors = {}
    for i, x, lab in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        if i % 100 == 0:
            anchors.setdefault(i, (x, lab))
    out = []
    for a, (ax, alab) in anchors.items():
        scored = sorted((-sum(p * q for p, q in zip(ax, x)), i, lab) for i, x, lab in rows if i != a)
        for place, (s, i, _) in enumerate([r for r in scored if r[2] == alab][:positives]):
            fit = [r for r in scored if r[2] != alab and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            out += [(a, i, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,step,parts", [(4096, 16, 20_000), (7, 1, 2), (64, 5, 1)])
def test_negatives_brute_force(vectors, block_rows, step, parts):
    rows = vector_rows()
    table = bond_negatives.labelled(vectors(rows).repartition(3))
    found = bond_negatives.mine(table, table.where("vec_id % 100 = 0"), block_rows=block_rows, step=step, anchor_block=parts)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute_negatives(rows) and len(got) > 100


def test_negatives_one_hot_label_and_wide_values(vectors):
    rows = [(i, [float(c) for c in (rng.normal(size=12) * 1e5).astype(np.float32)], 0 if i % 3 else i % 4) for i in range(300)]
    table = bond_negatives.labelled(vectors(rows))
    got = sorted(tuple(r) for r in bond_negatives.mine(table, table.where("vec_id % 100 = 0"), block_rows=50).collect())
    assert got == brute_negatives(rows)


def test_negatives_empty_and_lonely(vectors):
    for rows in ([], [(0, [1.0, 2.0], 1)], [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 2)], [(0, None, 1)]):
        table = bond_negatives.labelled(vectors(rows))
        assert bond_negatives.mine(table, table.where("vec_id % 100 = 0")).count() == 0


def test_scan_reads_less_than_all():
    """The bitmap shrinks before the last dimension is read."""
    x = np.array([[100, 1, 1], [90, 2, 0], [-100, 0, 1], [-90, 1, 2]])
    names = ["ids", "labels", "starts", "segment_labels", "low", "high", "width", "dims"]
    block = bond_negatives.Block(dict(zip(names, bond_negatives._block(np.arange(4), np.zeros(4, np.int64), x))))
    left = []

    def keep(lower, upper):
        stay = upper >= bond_negatives._kth(lower, 2)
        left.append(int(stay.sum()))
        return stay
    rows, scores = block.scan(np.array([50, 1, 1]), np.arange(4), keep, 1)
    assert left == [4, 2, 2, 2] and sorted(scores.tolist()) == [4502, 5002]
    assert rows.tolist() == [0, 1]


def brute_whitening(rows):
    xs = [x for _, x, _ in taking(rows)]
    fit = np.array(sorted(set(map(tuple, xs))), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    far = fit * n - sums
    v = np.array([[float(Fraction(int(c), n ** 3)) for c in row] for row in far.T @ far])
    w, q = np.linalg.eigh(v)
    return xs, n, sums, w[::-1], q[:, ::-1], np.trace(v)


def test_whitening_brute_force(vectors):
    rows = vector_rows()
    table = whitening.whole(vectors(rows).repartition(5))
    model = whitening.fit(table)
    xs, n, sums, w, q, trace = brute_whitening(rows)
    got = whitening.whiten(table, model).collect()
    assert len(got) == 4 * len(xs) and {r.n for r in got} == {n}
    ids = sorted(i for i, _, _ in taking(rows))
    assert sorted(r.vec_id for r in got if r.component == 2) == ids
    near = {}
    for i, x, _ in taking(rows):
        far = np.array([n * c - s for c, s in zip(x, sums)], dtype=object)
        near.setdefault(i, []).append((int((far * far).sum()), (far.astype(float) / n) @ q[:, :4] / np.sqrt(w[:4])))
    sign = {}
    for r in sorted(got, key=lambda r: (r.vec_id, r.component)):
        assert r.deviation in [d for d, _ in near[r.vec_id]]
        want = [p[r.component - 1] for d, p in near[r.vec_id] if d == r.deviation]
        s = sign.setdefault(r.component, 1 if r.whitened * want[0] > 0 else -1)
        assert min(abs(r.whitened - s * x) for x in want) < 1e-11
        assert r.explained == pytest.approx(w[r.component - 1] / trace, rel=1e-12)
        assert r.identity_error < 1e-12


def test_whitening_is_the_same_whatever_the_tasks(vectors):
    rows = vector_rows()
    models = [whitening.fit(whitening.whole(vectors(rows).repartition(k))) for k in (1, 7)]
    assert (models[0].vectors == models[1].vectors).all() and (models[0].values == models[1].values).all()


def test_whitening_defined_cases(vectors):
    assert whitening.fit(whitening.whole(vectors([]))) is None
    assert whitening.whiten(whitening.whole(vectors([])), None).count() == 0
    one = whitening.whole(vectors([(1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)]))
    got = whitening.whiten(one, whitening.fit(one)).collect()
    assert len(got) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, None, None)}
    line = whitening.whole(vectors([(i, [float(i), 0.0, 5.0, 1.0, 2.0, 3.0], 0) for i in range(9)]))
    got = whitening.whiten(line, whitening.fit(line)).collect()
    assert len(got) == 36 and all((r.whitened is None) == (r.component > 1) for r in got)
    assert all(r.identity_error < 1e-12 for r in got)
    assert {r.explained for r in got} == {0.0, 1.0}
    huge = whitening.whole(vectors([(1, [1e13, 0.0], 0), (2, [-1e13, 1.0], 0), (3, [3e38, 0.0], 0)]))
    got = whitening.whiten(huge, whitening.fit(huge)).collect()
    assert {r.vec_id for r in got} == {1, 2} and {r.deviation for r in got} == {None}
    assert all(abs(abs(r.whitened) - 1) < 1e-9 for r in got if r.component == 1)


@pytest.mark.parametrize("values", [
    [1, 1 + 1e-9, 1 + 2e-9, 0.5, 0.5 + 1e-12, 0.25, 1e-3, 1e-4], [3, 3, 3, 1, 1, 0.5, 0.25, 0.125], [1] * 8,
    [1, 1 - 1e-7, 1 - 2e-7, 1 - 4e-7, 1e-6, 1e-7, 0, 0], [8, 7, 6, 5, 4, 3, 2, 1]])
def test_eigenvectors_of_clustered_eigenvalues(values):
    high = np.longdouble
    q = np.linalg.qr(np.random.default_rng(8).normal(size=(8, 8)))[0].astype(high)
    for _ in range(3):  # orthogonal in the wide float
        q = q + q @ (np.eye(8, dtype=high) - q.T @ q) / 2
    v = q @ np.diag(np.array(values, high)) @ q.T
    v = (v + v.T) / 2
    w, x = whitening.eigen(v)
    assert np.abs(x.T @ x - np.eye(8)).max() < 1e-17
    assert np.abs(v @ x - x * w).max() < 4e-17 * max(values)
    want = np.sort(np.array(values, high))[::-1]
    assert np.abs(w - want).max() < 1e-17 * max(values)
    order = np.argsort(-np.array(values, high), kind="stable")
    for k in range(8):
        if np.abs(np.delete(want, k) - want[k]).min() > 1e-10:  # its own direction
            assert 1 - abs(float(x[:, k] @ q[:, order[k]])) < 1e-14


def test_products_are_exact():
    for top in (10, 1 << 25, 1 << 33, 1 << 52):
        y = np.array([[top, -top + 1], [top - 3, 7]], np.int64)
        want = y.astype(object).T @ y.astype(object)
        assert (whitening.products(y) == want).all()


TEXTS = [None, "", " ", "   ", "Hello  world", " leading and trailing  ", "tab\tand\nline\r\n", "a\x00b", "é漢字かな 한국어",
         "▁mark ▁▁ inside", "<s></s><unk><0x41>", "🙂👩‍👩‍👧 emoji", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20, "x" * 70 + " " * 41 + "y" * 65,
         "मानक हिन्दी", "العربية", "http://example.com/a?b=c&d=1", "https://x.y " * 50, "​﻿ nbsp", "é combining",
         "0123456789" * 30, "漢字" * 200, "The quick brown fox" * 1000]


def test_pieces_equal_the_library(spark):
    ship(spark)
    from sentencepiece import SentencePieceProcessor
    library = SentencePieceProcessor(model_file=piece_codec.model_path())
    random.seed(1)
    noise = ["".join(random.choice("ab \t▁<>é漢🙂.0th" + "eing ") for _ in range(random.randint(0, 300))) for _ in range(300)]
    rows = [(k, t, "x", "y") for k, t in enumerate(TEXTS + noise)] + [(None, "no id", "x", "y"), (4, "Hello  world", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, n_tokens string")
    back = piece_codec.decode(piece_codec.encode(docs)).collect()
    want = sorted((i if i is not None else -1, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, _, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.token_ids, r.text) for r in back) == want
    assert piece_codec.differences(docs).count() == 0
    assert piece_codec.encode(docs.limit(0)).count() == 0


def test_pieces_of_whole_table(spark):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert piece_codec.differences(docs).count() == 0


def test_piece_query_digests(spark, tmp_path):
    from sentencepiece import SentencePieceProcessor
    from livemart.llm.queries import op12_piece_codec
    library = SentencePieceProcessor(model_file=piece_codec.model_path())
    spark.createDataFrame([(1, "Hello  world"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op12_piece_codec(spark, str(tmp_path)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    ids = library.encode("Hello  world")
    assert tuple(got[1]) == (1, len(ids), sha(",".join(map(str, ids))), sha("Hello  world"))
    assert tuple(got[2]) == (2, 0, sha(""), sha(""))


def test_merge_without_remembering():
    """One chunk or many, by the heap or side by side, remembered or not: the same ids."""
    own = piece_codec.Codec(piece_codec.model_path())
    for t in TEXTS:
        want = own.library.encode(t or "")
        text = own.library.normalize(t or "")
        spelt = [own.pieces[s][0] if s in own.pieces else s for s in own.merge(text)]
        assert [i for s in spelt for i in ([s] if isinstance(s, int) else [own.bytes[b] for b in s.encode()])] == want
        for _ in range(2):
            ids, cuts = own.encode(["x", t or "", "y"])
            assert ids[cuts[1]:cuts[2]].tolist() == want
    random.seed(4)
    many = ["".join(random.choice("theingrasdou▁,.'\n漢é") for _ in range(random.randint(1, 64))) for _ in range(2000)]
    number, symbols = own.merge_short(many)
    for k, chunk in enumerate(many):
        left = [own.pieces[s][0] if s in own.pieces else own.size + ord(s) for s in own.merge(chunk)]
        assert symbols[number == k].tolist() == left
