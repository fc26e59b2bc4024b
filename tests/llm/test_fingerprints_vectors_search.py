"""Order MinHash, QDWH whitening and K2-treap search against plain versions."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from tilelake.llm import k2_treap, order_minhash, qdwh_whiten  # noqa: E402

SCHEMA = "doc_id long, text string, h long, part int, rank int, score long, signature string"


def words(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 8))) for _ in range(n))


def docs(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, "x") for i, t in rows], SCHEMA).repartition(parts)


def odd_rows():
    """Nulls, blanks, copies, repeated rows and ids, wide characters, short and very long texts."""
    base = words(1, 200)
    return [(1, base), (2, base), (3, None), (4, ""), (5, "ab"), (6, "x" * 5000), (7, "naïve 世界 ΑΣ́ \U0001f600 " * 30), (8, words(2, 20_000)), (9, base + " tail"),
            (10, words(3, 60)), (10, words(4, 60)), (11, words(5, 60)), (11, words(5, 60)), (None, words(6, 60)), (None, None), (12, "It's A-Z, a-z; 0-9\n\tÄ İ ﬁ"), (13, " \n.,;")]


# -- Order MinHash ---------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["a", "abcdefg", "abcdefgh", "aaaaaaaaaaaaaaaaaaaa", words(9, 400), words(10, 900) + "世界 \U0001f600" * 40, "ab" * 3000])
def test_signature_matches_plain_minima(text):
    assert order_minhash.Sketcher()(text).tolist() == brute.order_minhash(text, order_minhash.orders().tolist(), order_minhash.K, order_minhash.CHOSEN)


def test_likeness_follows_order_and_repeats():
    sketch = order_minhash.Sketcher(sketches=512)
    one, two = words(20, 300), words(21, 300)
    like = lambda a, b: order_minhash.likeness(sketch(a), sketch(b))
    assert like(one, one) == 1.0
    assert like(one, two) < 0.02
    edits = [one[:300] + two[:n] + one[300 + n:] for n in (20, 200, 800)]
    likes = [like(one, e) for e in edits]
    assert likes == sorted(likes, reverse=True) and likes[0] > 0.85
    halves = one + " " + two, two + " " + one
    assert like(*halves) < 0.7  # the same shingles in another order
    assert like(one + " " + one, one) < 0.75  # the same shingles twice


def test_neighbours_match_plain_loop(spark):
    rows = odd_rows()
    found = order_minhash.report(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    texts = [(i, t or "") for i, t in rows]
    import xxhash

    signed = lambda x: x - (1 << 64) if x >> 63 else x
    key = lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64_intdigest(r[1].encode(), 42)))
    texts.sort(key=key)
    factors = order_minhash.orders().tolist()
    sign = {t: brute.order_minhash(t, factors, order_minhash.K, order_minhash.CHOSEN) if len(t) < 6000 else order_minhash.Sketcher()(t).tolist() for _, t in texts}
    hexed = lambda s: "".join(f"{x:04x}" for x in s)
    share = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) / len(a)
    want = []
    for n, (i, t) in enumerate(texts):
        after = texts[(n + 1) % len(texts)][1]
        take = len(t) // 3
        changed = t[:len(t) - take] + after[:take]
        then = order_minhash.Sketcher()(changed).tolist()
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), hexed(sign[t]), hexed(then), share(sign[t], then), share(sign[t], sign[after])))
    assert Counter(map(tuple, found)) == Counter(want)


def test_neighbours_of_one_and_none(spark):
    one = order_minhash.report(docs(spark, [(1, words(1, 50))])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert order_minhash.report(docs(spark, [])).count() == 0
    both = order_minhash.report(docs(spark, [(1, None), (2, "")])).collect()
    assert [(r.near_edited, r.near_next, r.n_chars) for r in both] == [(1.0, 1.0, 0)] * 2


def test_fingerprints_and_their_likeness(spark):
    from pyspark.sql import functions as F

    rows = order_minhash.fingerprints(docs(spark, odd_rows())).select("doc_id", order_minhash.printed(F.col("signature")).alias("f"))
    by = {r.doc_id: r.f for r in rows.collect()}
    assert rows.count() == len(odd_rows()) and by[1] == by[2] and by[3] == by[4] == "0" * 256
    pair = spark.createDataFrame([(by[1], by[9])], "a string, b string").select(order_minhash.likeness_of(F.col("a"), F.col("b")).alias("x")).first()
    sketch = order_minhash.Sketcher()
    assert pair.x == order_minhash.likeness(sketch(words(1, 200)), sketch(words(1, 200) + " tail"))


# -- QDWH whitening --------------------------------------------------------------------------------


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [1, 1, 1, 1], [3, 3, 1, 1, 0], [0, 0], [1e8, 1, 1e-8, 0], [2], list(range(40, 0, -1)), [1 + 1e-9, 1, 0.5]])
def test_spectrum_of_known_matrices(values):
    turn, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values),) * 2))
    a = turn @ np.diag(np.array(values, float)) @ turn.T
    found, vectors = qdwh_whiten.spectrum(a)
    top = max(map(abs, values)) or 1
    assert np.allclose(found, sorted(values, reverse=True), rtol=0, atol=1e-14 * len(values) * top)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert np.allclose(a @ vectors, vectors * found, atol=1e-13 * len(values) * top)
    part, first = qdwh_whiten.spectrum(a, 2)
    assert np.allclose(part, found[:2], rtol=0, atol=1e-13 * len(values) * top) and first.shape == (len(values), min(2, len(values)))


def test_polar_factor_is_orthogonal_and_leaves_a_symmetric_part():
    a = np.random.default_rng(4).standard_normal((30, 30)) @ np.diag(np.logspace(0, -9, 30))
    u = qdwh_whiten.polar(a, 1e-11)
    h = u.T @ a
    assert np.allclose(u.T @ u, np.eye(30), atol=1e-12) and np.allclose(h, h.T, atol=1e-12) and np.linalg.eigvalsh((h + h.T) / 2).min() > -1e-12


def vectors(spark, rows, parts=3):
    real = [(i, v and [None if c is None else float(c) for c in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, 0, 1) for i, v in real], "vec_id long, embedding array<float>, x int, n int").repartition(parts)


def test_whitening_matches_plain_eigenvectors(spark):
    rng = np.random.default_rng(8)
    base = (rng.standard_normal((120, 6)) @ np.diag([3, 2, 1.5, 1, 0.5, 0.2])).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(500 + i, base[0]) for i in range(60)] + [(0, base[1]), (None, base[2])]
    bad = [(900, None), (901, [1.0, None, 0, 0, 0, 0]), (902, [math.nan] * 6), (903, [math.inf] + [0.0] * 5), (904, []), (905, [1.0, 2.0]), (906, [3e38] * 6)]
    got = qdwh_whiten.report(vectors(spark, rows + bad)).collect()
    assert len(got) == 4 * len(rows)
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for v in base])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = (fit - s / n).T @ (fit - s / n) / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    want = {tuple(r): ((np.array(r) - s / n) @ w[:, :4] / np.sqrt(e[:4]), int(((n * np.array(r) - s) ** 2).sum())) for r in x.tolist()}
    at = {**dict(enumerate(map(tuple, x.tolist()))), **{500 + i: tuple(x[0].tolist()) for i in range(60)}}
    signs = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-10 and abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-12
        if r.vec_id is None or r.vec_id == 0:
            continue
        white, deviation = want[at[r.vec_id]]
        signs.setdefault(r.component, 1.0 if white[r.component - 1] * r.whitened >= 0 else -1.0)
        assert r.deviation == deviation and abs(white[r.component - 1] * signs[r.component] - r.whitened) < 1e-9
    assert Counter(r.vec_id for r in got)[0] == 8 and Counter(r.vec_id for r in got)[None] == 4


def test_whitening_without_variance(spark):
    assert qdwh_whiten.report(vectors(spark, [])).count() == 0
    assert qdwh_whiten.report(vectors(spark, [(1, None)])).count() == 0
    assert qdwh_whiten.report(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    line = qdwh_whiten.report(vectors(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(5)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12


# -- K2-treap search -------------------------------------------------------------------------------


def test_terms_are_the_contracts():
    for text in [t or "" for _, t in odd_rows()] + ["\x00a\x7fb{c}D[E]F\\g^h_i`j@k/l0:9", "ÀÉ世 x y z"]:
        plain = re.findall(k2_treap.TERM, text.translate({c: c + 32 for c in range(65, 91)}))
        assert [t.decode() for t in k2_treap.terms(text)] == plain


def test_tree_holds_every_cell():
    pick = random.Random(2)
    cells = {(pick.randrange(300), pick.randrange(70)): pick.randrange(1, 1000) for _ in range(900)} | {(0, 0): 5}
    r, c = np.array(list(cells)).T
    tree = k2_treap.Treap(*k2_treap.plant(r, c, np.array(list(cells.values()))))
    for row in range(300):
        at, scores, _ = tree.best(np.array([row]), np.array([1]), 1000)
        assert dict(zip(at.tolist(), scores.tolist(), strict=True)) == {y: v for (x, y), v in cells.items() if x == row}


def test_best_is_exact_with_ties():
    pick = random.Random(3)
    cells = {(pick.randrange(64), pick.randrange(500)): pick.choice([10, 20, 30]) for _ in range(6000)}
    r, c = np.array(list(cells)).T
    tree = k2_treap.Treap(*k2_treap.plant(r, c, np.array(list(cells.values()))))
    rows, weights = np.array([0, 3, 9, 40, 63]), np.array([5, 1, 2, 2, 1])
    full = Counter()
    for (x, y), v in cells.items():
        if x in rows:
            full[y] += v * int(weights[rows.tolist().index(x)])
    last = sorted(full.values(), reverse=True)[9]
    at, scores, least = tree.best(rows, weights, 10)
    assert dict(zip(at.tolist(), scores.tolist(), strict=True)) == {y: s for y, s in full.items() if s >= last} and least == last


@pytest.mark.parametrize("cells,columns,item_terms", [(k2_treap.CELLS, k2_treap.COLUMNS, k2_treap.ITEM_TERMS), (60, 3, 5)])
def test_ranking_matches_plain_scores(spark, cells, columns, item_terms):
    rows = odd_rows() + [(100 + i, words(30 + i % 25, 40)) for i in range(60)]
    items = [(1, words(30, 30)), (2, words(31, 5) + " " + words(32, 5)), (3, None), (4, "nothing like this"), (5, words(40, 40).upper()), (5, words(41, 40)), (6, words(42, 9)), (6, words(42, 9)), (None, words(43, 9))]
    table = docs(spark, rows)
    asked = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, term string")
    counts = k2_treap.totals(table)
    index = k2_treap.build(table, counts, cells=cells, columns=columns)
    got = k2_treap.search(index, asked, counts[0], item_terms=item_terms).collect()
    assert Counter(map(tuple, got)) == Counter(brute.ranked(rows, items, k2_treap.TERM))


def test_search_of_nothing(spark):
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert k2_treap.ranked(docs(spark, []), asked).count() == 0
    assert k2_treap.ranked(docs(spark, [(1, None), (2, ".")]), asked).count() == 0
    assert k2_treap.ranked(docs(spark, [(1, "a")]), asked.limit(0)).count() == 0
    assert [tuple(r) for r in k2_treap.ranked(docs(spark, [(1, "b c"), (2, "c d"), (3, "d e")]), asked).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]
