"""The training-data operators on small tables, against plain versions, with nulls, ties, repeats and nothing."""

from __future__ import annotations

import os
import random
import sys
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from tilelake.llm import (  # noqa: E402
    components,
    entropy_mix,
    fuzzy_lines,
    line_frequency,
    pu_toxicity,
    secret_grammar,
    segment_bpe,
    simhash_tiles,
    stream_dedup,
    url_intervals,
    warc_merge,
)
from tilelake.session import scratch_path  # noqa: E402

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, score string, copies int, `_body` int"


def words(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 8))) for _ in range(n))


def lines(seed: int, n: int) -> str:
    return "\n".join(words(seed * 100 + i, 12) for i in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, blanks, copies, near copies, repeated rows, repeated ids, and one very long text."""
    base = lines(1, 8)
    near = base.replace(base.split()[40], "changed", 1)
    long = words(3, 30_000)
    return [
        (1, base, "a"), (2, base, "a"), (3, base.upper(), None), (4, near, "b"), (5, None, "a"), (6, "", None), (7, " \n\t\r\n ", "b"),
        (8, long, "c"), (9, "x", "c"), (10, "one two", "é"), (11, lines(4, 5), "a"), (11, lines(5, 5), "a"), (12, lines(6, 4), "b"), (12, lines(6, 4), "b"),
        (None, lines(7, 4), "a"), (13, "It's 12 naïve <|endoftext|> ΑΣ́ İ ﬁ \x1c don’t 'll　x" + "y" * 300, "b"),
        (14, "a b c a b c a b c " * 10, "c"), (15, "\n".join(["same old line here"] * 30 + [words(8, 60)]), "b"),
    ]


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "x", 9, 1) for i, t, s in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def want(rows):
    return sorted(map(tuple, rows), key=repr)


# -- components ---------------------------------------------------------------------------------


def test_components_match_union_find(spark):
    pick = random.Random(5)
    edges = [(pick.randrange(400), pick.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)] + [(3, 3)]
    sets = brute.Sets()
    for a, b in edges:
        if a != b:
            sets.join(a, b)
    df = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert got(df) == want((x, sets.find(x)) for x in list(sets.up))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- WARC -----------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    big, odd = "x" * 1500, "tail\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    pages = [(1, "http://b.example/1", big), (2, "http://a.example/2", big), (3, None, "short"), (4, "http://a.example/2", "short"), (5, "http://a.example/é x\n%", odd),
             (6, "https://A.example:8/?q#f", None), (None, "http://c.example", big), (7, "http://a.example/7", "ü" * 700), (7, "http://a.example/7", "ü" * 700)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, payload string").repartition(4)
    index = warc_merge.round_trip(df)
    found = [(int(r.id) if r.id else None, r.bytes, r.digest, r.type, r.refers_to and int(r.refers_to)) for r in index.collect()]
    import hashlib

    expected = []
    for i, _, html in pages:
        body = (html or "").encode()
        same = [p for p, _, h in pages if h == html and p is not None]
        stays = max(same) if len(body) >= 1000 else i
        expected.append((i, len(body), hashlib.sha1(body).hexdigest(), "response" if i == stays else "revisit", None if i == stays else stays))
    assert want(found) == want(expected)
    assert {r.url for r in index.collect()} == {u or "" for _, u, _ in pages}
    assert warc_merge.round_trip(df.limit(0)).count() == 0


def test_warc_index_is_in_global_order_over_ranges(spark):
    pages = spark.range(500).selectExpr("id AS page_id", "concat('http://h', id % 3, '.example/', id % 7) AS url", "repeat('p', int(id % 50)) AS html")
    path = scratch_path(spark, "t-archives")
    warc_merge.write_archives(pages, path, "page_id", "url", "html", F.timestamp_seconds(F.col("page_id") % 11), archive_bytes=20_000)
    index = sorted(warc_merge.merge_runs(warc_merge.read_runs(spark, path), range_entries=60).collect(), key=lambda r: (r.shard, r.place))
    keys = [(r.key, r.date, r.id, r.offset) for r in index]
    assert len(keys) == 500 and keys == sorted(keys) and len({r.shard for r in index}) > 4 and len({r.run for r in index}) > 2


def test_loser_tree_merges_any_number_of_runs():
    pick = random.Random(1)
    for k in range(9):
        runs = [sorted(pick.randrange(50) for _ in range(pick.randrange(6))) for _ in range(k)]
        assert list(warc_merge.LoserTree(runs, lambda x: (x,))) == sorted(sum(runs, []))


# -- secrets --------------------------------------------------------------------------------------


def test_secret_spans(spark, empty):
    import re

    texts = [None, "", 'é token = "abc123" PASSWD:short api_Key=0123456789abcdef0123456789', "AKIA" + "A1" * 8 + " AKIA123 " + "ab" * 12 + " " + "ab" * 11,
             "secret secret=x token:=y", "password='aa.bb/cc+dd==' " * 3]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = {r.doc_id: [(b.start, b.kind, b.end) for b in r.base] for r in secret_grammar.scan(df).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        a = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(1)) >= 6]
        b = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
        c = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
        assert found[i] == sorted(a + b + c)
    assert secret_grammar.report(empty).count() == 0


def test_grammar_finds_unlabelled_credentials_of_the_labelled_form(spark):
    pick = random.Random(2)
    key = lambda: "sk-" + "".join(pick.choice("0123456789ABCDEFGHJKLMNPQRSTUVWXYZ") for _ in range(24))
    plain = lambda: pick.choice(["chapter-2-of-the-longer-book", "photos/2024/summer/holiday", "version-1-0-release-notes"]) + "-x" * pick.randrange(3)
    texts = [f"token = {key()} {plain()} {plain()}" for _ in range(200)] + [f"lost {key()} here" for _ in range(20)] + [plain() for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: len(r.added) for r in secret_grammar.scan(df).collect()}
    assert sum(rows[i] == 1 for i in range(200, 220)) >= 18
    assert sum(rows[i] for i in range(220, 420)) == 0


@pytest.mark.parametrize("length,filled", [(12, True), (12, False), (20, True), (20, False)])
def test_short_unlabelled_credentials_are_scored(spark, length, filled):
    pick = random.Random(length)
    signs = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    value = lambda: "".join(pick.choice(signs) for _ in range(length))
    plain = lambda i: words(i, 30) if filled else ""
    texts = [f"{plain(i)} token = {value()} {plain(i + 500)}" for i in range(200)] + [f"lost {value()} {plain(i)}" for i in range(50)]
    rows = secret_grammar.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sum(len(r.added) == 1 for r in rows if r.doc_id >= 200) >= 45
    assert sum(len(r.added) for r in rows if r.doc_id < 200) <= 4


def test_every_letter_of_a_long_string_is_scored(spark):
    """Strings of 240 to 250 signs that begin alike: those that go on as the labelled ones do are found, the others aren't."""
    pick = random.Random(5)
    code = lambda n: "".join(pick.choice("0123456789GHJKLMNPQRSTVWXYZ") for _ in range(n))
    length = lambda: pick.randrange(240, 250)
    texts = [f"token = {code(length())} {words(i, 10)}" for i in range(200)] + [f"lost {code(length())}" for _ in range(20)]
    texts += [f"seen {code(80)}" + "".join(pick.choice("ghjkmnpqrstvwxyz") for _ in range(length() - 80)) for _ in range(20)]
    rows = {r.doc_id: len(r.added) for r in secret_grammar.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(rows[i] == 1 for i in range(200, 220)) >= 18
    assert sum(rows[i] for i in range(220, 240)) == 0


def test_secret_report_is_the_plain_digest(spark):
    import hashlib

    texts = [None, "", "token=abcdef123 AKIA" + "B2" * 9 + " x " + "0a" * 13, words(3, 30_000) + " password: hunter22 ", "api_key = 0123456789abcdef01234567", "naïve secret='é' token=ab"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[2]), (2, texts[2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, base string")
    expected = []
    for i, t in rows:
        base = brute.secret_spans(t or "")
        text = ",".join(f"{k}:{s}:{e}" for s, k, e in base)
        expected.append((i, *(sum(b[1] == k for b in base) for k in ("assign", "access", "hex")), hashlib.sha256(text.encode()).hexdigest(), text, 0))
    assert got(secret_grammar.report(df)) == want(expected)


def test_secrets_are_scored_where_the_library_is_not_on_the_path():
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys; sys.path.insert(0, {root!r})
import random
from tilelake import build_session
from tilelake.llm import secret_grammar
spark = build_session("away", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
pick = random.Random(1)
value = lambda: "".join(pick.choice("0123456789abcdefXYZ") for _ in range(32))
rows = [(i, ("token = " if i < 60 else "") + "X" + value()) for i in range(70)]
print("found", sum(len(r.added) for r in secret_grammar.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
"""
    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd="/", env=bare, capture_output=True, text=True, timeout=300)
    assert "found" in done.stdout and int(done.stdout.split("found")[1]) >= 9, done.stderr[-2000:]


def test_candidates_are_cut_at_labelled_spans():
    text = "abcdef" + "token=secret99" + " /path/AKIA" + "Z9" * 10 + " tail12"
    base = secret_grammar.base_spans(text)
    assert [text[s:e] for s, e in secret_grammar.candidates(text, base)] == ["abcdef", "/path/", "tail12"]


def test_automaton_merges_states():
    # Each digit is followed by another one in nine of ten cases, wherever it stands: one looping state says it all.
    tree = secret_grammar.Automaton(["9" * n for n in range(1, 64) for _ in range(int(1000 * 0.9**n))])
    assert tree.states <= 3
    assert tree.likelihood("9999999") > tree.likelihood("zzz9zzz")


# -- exact dedup ------------------------------------------------------------------------------------


def exact(rows):
    out = []
    for i, t, *_ in rows:
        same = [(j is not None, j or 0) for j, u, *_ in rows if (u or "").translate(brute.UPPER) == (t or "").translate(brute.UPPER)]
        out.append((i, max(same)[1] if max(same)[0] else None, len(same)))
    return out


@pytest.mark.parametrize("digest", [stream_dedup.sha256, lambda t: F.lit("same")], ids=["sha256", "all-collide"])
def test_stream_dedup(spark, docs, rows, digest):
    path = scratch_path(spark, "t-docs")
    docs.write.parquet(path)
    df = stream_dedup.dedup(spark, path, digest=digest)
    assert got(df.select("doc_id", "keep_id", "group_size")) == want(exact(rows))
    texts = {(t or "").translate(brute.UPPER) for _, t, _ in rows}
    assert df.where("kept").count() == len(texts)
    assert df.where("kept AND NOT (doc_id <=> keep_id)").count() == 0


def test_stream_dedup_goes_on_where_it_stopped(spark):
    path, root = scratch_path(spark, "t-docs"), scratch_path(spark, "t-state")
    one = spark.createDataFrame([(1, "A"), (2, "b")], "doc_id long, text string")
    two = spark.createDataFrame([(3, "a"), (4, "c")], "doc_id long, text string")
    one.write.parquet(path)
    assert stream_dedup.dedup(spark, path, root=root).where("group_size > 1").count() == 0
    two.write.mode("append").parquet(path)
    assert got(stream_dedup.dedup(spark, path, root=root).select("doc_id", "keep_id", "group_size", "kept")) == [
        (1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 4, 1, True)]


def test_stream_dedup_of_nothing(spark, empty):
    path = scratch_path(spark, "t-docs")
    empty.write.parquet(path)
    assert stream_dedup.dedup(spark, path).count() == 0


# -- source mix ---------------------------------------------------------------------------------------


def test_mix_meets_targets(spark):
    pick = random.Random(3)
    rows = [(i, words(i, int(pick.paretovariate(1.2) * 20) % 3000 + 1), pick.choice(["s1"] * 20 + ["s2", "s3", "é", None, "S", "zz"])) for i in range(3000)]
    rows += [(5000 + i, None, "empty") for i in range(5)] + [(6000, "w " * 10, "tiny")]
    df = table(spark, rows)
    got_rows = entropy_mix.plan(df).collect()
    sizes, taken = {}, {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.WORD.findall(t or ""))
    aim = brute.mix_targets(sizes)
    for r in got_rows:
        assert r.target == pytest.approx(aim[r.source], rel=1e-9)
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"] and r.source_size == sizes[r.source]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        assert t == pytest.approx(aim[s], rel=0.02, abs=20), s
    again = entropy_mix.plan(df.repartition(7)).collect()
    assert want((r.doc_id, r.taken) for r in got_rows) == want((r.doc_id, r.taken) for r in again)
    mixed = entropy_mix.mix(df)
    assert mixed.columns == df.columns
    copies = {r.doc_id: r.copies for r in got_rows if r.copies}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies


def test_mix_shares_copies_out_among_repeats(spark):
    one = words(1, 10)
    rows = [(1, one, "a")] * 4_000 + [(2 + i, words(2 + i, 10), "b") for i in range(200)]
    df = table(spark, rows, 8)
    plan = entropy_mix.plan(df)
    taken = {r.source: r.t for r in plan.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    aim = brute.mix_targets({"a": 40_000, "b": 2_000})
    assert plan.count() == len(rows) and plan.where("taken > 3 * size").count() == 0
    assert all(abs(taken[s] - aim[s]) <= 10 for s in aim)
    mixed = {r.source: r.n * 10 for r in entropy_mix.mix(df).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert mixed == taken


def test_mix_edges(spark, docs, rows, empty):
    assert entropy_mix.plan(docs).count() == len(rows)
    assert entropy_mix.plan(empty).count() == 0
    blank = entropy_mix.plan(table(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.target, r.taken, r.copies) for r in blank] == [(0.0, 0, 1)] * 2


# -- lines ----------------------------------------------------------------------------------------------


def edited(rows_seed: int):
    pick = random.Random(rows_seed)
    out = []
    for i in range(60):
        text = [words(i % 20 * 50 + k, pick.choice([3, 6, 12, 30])) for k in range(4)]
        if i >= 20:
            text = [" ".join(pick.choice([w, w, w, w, w + "s"]) if pick.random() < 0.1 else w for w in t.split()) for t in text]
        out.append((i, "\n".join(text), "a"))
    return out


def test_fuzzy_lines(spark, docs, rows, empty):
    unique = [r for r in rows if r[0] is not None and [x[0] for x in rows].count(r[0]) == 1]
    some = unique + [(100 + i, t, s) for i, t, s in edited(1)]
    found = {r.doc_id: list(r.removed) for r in fuzzy_lines.report(table(spark, some)).collect()}
    # Banding may miss a pair near the threshold, but nothing goes that all pairs would keep.
    expected = brute.fuzzy_lines([r[:2] for r in some])
    assert found.keys() == expected.keys() and all(set(found[i]) <= set(expected[i]) for i in found)
    assert sum(map(len, found.values())) >= 0.97 * sum(map(len, expected.values()))
    assert fuzzy_lines.report(docs).count() == len(rows) and fuzzy_lines.report(empty).count() == 0
    cleaned = {r.doc_id: r.text for r in fuzzy_lines.dedup(table(spark, some)).collect()}
    for i, t, _ in some:
        assert cleaned[i] == (t if not found[i] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in found[i]))


def test_fuzzy_lines_recall_and_large_groups(spark):
    base = words(9, 30)
    pick = random.Random(4)
    near = []
    for i in range(300):
        w = base.split()
        w[pick.randrange(30)] = words(1000 + i, 1)
        near.append((i, " ".join(w), "a"))
    found = fuzzy_lines.report(table(spark, near)).where("n_removed = 1").count()
    expected = sum(map(len, brute.fuzzy_lines([r[:2] for r in near]).values()))
    assert 0.97 * expected <= found <= expected


def test_fuzzy_lines_of_a_phrase_repeated_more_or_less_often(spark):
    rows, n = [], 0
    for seed, size, few, many in [(s, 8, 5, 100) for s in range(20)] + [(s, 8, 10, 40) for s in range(20, 40)] + [(s, 2, 3, 60) for s in range(40, 60)]:
        for times in (few, many):
            rows.append((n, " ".join([words(5000 + seed, size)] * times), "a"))
            n += 1
    sets = [brute.shingles(t) for _, t, _ in rows]
    assert all(sets[i] == sets[i + 1] for i in range(0, n, 2))
    found = {r.doc_id: list(r.removed) for r in fuzzy_lines.report(table(spark, rows)).collect()}
    assert found == {i: [0] if i % 2 else [] for i in range(n)}


def test_fuzzy_lines_compares_few_pairs_of_a_large_group(spark, monkeypatch):
    pick, base, near = random.Random(5), words(77, 40).split(), []
    for i in range(400):
        w = list(base)
        for _ in range(3):
            w[pick.randrange(40)] = words(2000 + 7 * i + pick.randrange(7), 1)
        near.append((i, " ".join(w), "a"))
    compared, verify = [], fuzzy_lines._verified
    monkeypatch.setattr(fuzzy_lines, "_verified", lambda pairs, *more: compared.append(pairs.count()) or verify(pairs, *more))
    found = fuzzy_lines.report(table(spark, near)).where("n_removed = 1").count()
    expected = sum(map(len, brute.fuzzy_lines([r[:2] for r in near]).values()))
    assert 0.97 * expected <= found <= expected
    assert 0 < sum(compared) <= 4 * len(near), compared


def test_fuzzy_lines_sketches_rule_out_no_similar_pair(spark):
    pick, pairs = random.Random(3), []
    for i in range(400):
        line = words(8000 + i, pick.choice([3, 20, 45, 60, 200, 330, 700]))
        other = list(line)
        for _ in range(pick.randrange(1, max(2, len(line) // 20))):
            other[pick.randrange(len(line))] = pick.choice("ijklmnop")
        pairs.append((line, "".join(other) + pick.choice(["", " " + words(9000 + i, 3)])))
    rows = spark.createDataFrame(pairs, "x string, y string")
    for c in "xy":
        rows = rows.withColumn(f"s{c}", fuzzy_lines._sketched(fuzzy_lines._shingles(F.col(c))))
    kept = {(r.x, r.y) for r in rows.where(fuzzy_lines._alike(F.col("sx.n"), F.col("sx.odd"), F.col("sy.n"), F.col("sy.odd"), 0.8)).collect()}
    likeness = {p: len(a & b) / len(a | b) for p in pairs for a, b in [tuple(map(brute.shingles, p))]}
    assert all(p in kept for p, j in likeness.items() if j >= 0.8) and sum(j >= 0.8 for j in likeness.values()) > 50
    low = [p for p, j in likeness.items() if j < 0.65]
    assert len(low) > 50 and sum(p in kept for p in low) <= 0.1 * len(low)


def test_fuzzy_lines_recall_of_pairs_near_the_threshold(spark):
    pick = random.Random(12)
    rows = []
    for i in range(300):
        line = words(9000 + i, pick.choice([6, 14, 25, 60]))
        near, whole = line, brute.shingles(line)
        while True:
            at = pick.randrange(len(near))
            changed = near[:at] + pick.choice("ijklmnop") + near[at + 1:]
            other = brute.shingles(changed)
            if len(whole & other) < 0.8 * len(whole | other):
                break
            near = changed
        if near != line:
            rows += [(2 * i, line, "a"), (2 * i + 1, near, "a")]
    found = fuzzy_lines.report(table(spark, rows)).where("n_removed = 1").count()
    assert 0.99 * len(rows) / 2 <= found <= len(rows) / 2


def test_fuzzy_lines_pairs_a_part_of_the_bands_at_a_time(spark, monkeypatch):
    written, write = [], fuzzy_lines.materialize

    def counted(df, label, keep=False):
        out = write(df, label, keep)
        if label in ("members", "placed"):
            written.append((label, out.count()))
        return out

    monkeypatch.setattr(fuzzy_lines, "materialize", counted)
    assert fuzzy_lines.report(table(spark, edited(1))).count() == 60
    members, placed = (sum(n for x, n in written if x == label) for label in ("members", "placed"))
    assert members == placed > 0
    assert max(n for x, n in written if x == "placed") < 0.6 * members


def test_line_frequency(spark, docs, rows, empty):
    common = [(200 + i, f"shared footer of the host\n{words(300 + i, 80)}", "h") for i in range(40)]
    spam = [(300 + i, f"{words(77, 70)}\n{words(400 + i, 20)}", "h") for i in range(40)]
    some = rows + common + spam
    limits = {"min_docs": 20, "max_share": 0.02, "min_left": 0.5}
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_left"]
    df = line_frequency.verdicts(table(spark, some), **limits)
    assert got(df.select(*columns)) == want(brute.line_rules(some, **limits))
    assert line_frequency.verdicts(empty).count() == 0
    cleaned = {r.doc_id: r.text for r in line_frequency.clean(table(spark, common + spam), **limits).collect()}
    assert cleaned == {i: t.split("\n")[1] for i, t, _ in common}


def test_line_frequency_limit_does_not_grow_with_the_host(spark):
    def held(n: int, common: int) -> int:
        rows = [(i, f"own line {i}" + ("\nthe footer" if i < common else ""), "h") for i in range(n)]
        return line_frequency.verdicts(table(spark, rows)).where("size(removed) > 0").count()

    assert held(5_000, 250) == 250
    assert held(15_000, 250) == 250
    assert held(15_000, 150) == 0


def test_line_frequency_counts_documents_or_texts(spark):
    copies = [(i, f"the footer\n{words(1, 80)}", "h") for i in range(500)]
    others = [(1000 + i, f"the footer\n{words(2 + i, 80)}", "h") for i in range(30)] + [(None, "the footer\n" + words(99, 80), None)] * 300
    limits = {"min_docs": 20, "max_share": 0.02, "min_left": 0.5}
    for by in ("documents", "texts"):
        df = line_frequency.verdicts(table(spark, copies + others), **limits, by=by)
        columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_left"]
        assert got(df.select(*columns)) == want(brute.line_rules(copies + others, **limits, by=by))
        assert df.where("host = 'h' and size(removed) = 0").count() == 0
    with pytest.raises(ValueError):
        line_frequency.verdicts(table(spark, copies), by="lines")


def test_operators_take_clashing_columns(spark):
    odd = "doc_id long, text string, source string, _v_id int, _v_host int, _v_body int, _v_removed int, _metadata string, _b_id int, _b_host int, _b_at int, _number int, _alike int"
    rows = spark.createDataFrame([(i, f"line {i}\n{words(i, 60)}", "a", 1, 2, 3, 4, "m", 5, 6, 7, 8, 9) for i in [*range(20), 3]], odd)
    assert line_frequency.clean(rows).columns == rows.columns and line_frequency.clean(rows).count() == 21
    assert entropy_mix.mix(rows).columns == rows.columns
    path = scratch_path(spark, "t-odd")
    rows.write.parquet(path)
    assert stream_dedup.dedup(spark, path).count() == 21
    pages = rows.withColumns({"url": F.concat(F.lit("http://a.example/"), "doc_id"), "at": F.timestamp_seconds(F.lit(1_700_000_000))})
    entries = spark.createDataFrame([("a.example", "block", 1_600_000_000)], "key string, action string, t long").select("key", "action", F.timestamp_seconds("t").alias("listed_at"))
    assert url_intervals.allowed(pages, entries, "doc_id", "url", "at").count() == 0


# -- URL lists ------------------------------------------------------------------------------------------


def test_url_intervals(spark):
    at = lambda d: f"2024-01-{d:02d} 00:00:00"
    entries = [("example.com", "block", at(5)), ("good.example.com", "allow", at(7)), ("example.com", "allow", at(20)), ("x.org", "allow", at(3)), ("x.org", "block", at(3)),
               (None, "block", at(1)), ("y.org", None, at(1)), ("z.org", "block", None)]
    captures = [(1, "http://a.example.com/x", at(4)), (2, "http://A.example.com", at(5)), (3, "https://u@good.example.com:8/", at(8)), (4, "http://good.example.com", at(6)),
                (5, "http://example.com", at(25)), (6, "http://x.org/", at(3)), (7, "http://notexample.com", at(9)), (8, None, at(9)), (9, "http://x.org", None), (2, "http://A.example.com", at(5)), (10, "junk", at(9))]
    c = spark.createDataFrame(captures, "id long, url string, at string").withColumn("at", F.col("at").cast("timestamp"))
    e = spark.createDataFrame(entries, "key string, action string, listed_at string").withColumn("listed_at", F.col("listed_at").cast("timestamp"))
    blocked = sorted(r.id for r in url_intervals.judge(c, e, "id", "url", "at").collect() if r.blocked)
    assert blocked == [2, 2, 4, 6]
    assert url_intervals.judge(c, e, "id", "url", "at").count() == len(captures)
    assert sorted(r.id for r in url_intervals.allowed(c, e, "id", "url", "at").collect()) == [1, 3, 5, 7, 8, 9, 10]
    assert url_intervals.judge(c, e.limit(0), "id", "url", "at").where("blocked").count() == 0
    assert url_intervals.judge(c.limit(0), e, "id", "url", "at").count() == 0


def test_url_intervals_of_a_host_with_many_labels(spark):
    host = "a.b.c.d.e.f.g.h.example.com"
    below = host.split(".", 1)[1]
    deep = ".".join(["x"] * 125 + ["example", "org"])
    entries = [("example.com", "allow", "2024-01-01 00:00:00"), (below, "block", "2024-01-02 00:00:00"), (deep.split(".", 2)[2], "block", "2024-01-02 00:00:00")]
    captures = [(1, f"http://{host}/", "2024-01-03 00:00:00"), (2, f"http://{below}/", "2024-01-03 00:00:00"), (3, f"http://{deep}/", "2024-01-03 00:00:00"),
                (4, f"http://{below.split('.', 1)[1]}/", "2024-01-03 00:00:00")]
    c = spark.createDataFrame(captures, "id long, url string, at string").withColumn("at", F.col("at").cast("timestamp"))
    e = spark.createDataFrame(entries, "key string, action string, listed_at string").withColumn("listed_at", F.col("listed_at").cast("timestamp"))
    found = {r.id: (r.entry, r.blocked) for r in url_intervals.judge(c, e, "id", "url", "at").collect()}
    assert found == {1: (below, True), 2: (below, True), 3: (entries[2][0], True), 4: ("example.com", False)}


# -- toxicity ---------------------------------------------------------------------------------------------


def test_pu_learning_is_right_on_held_out_rows(spark, empty):
    pick = random.Random(6)
    rows, labels = [], []
    for i in range(1500):
        toxic = pick.random() < 0.2
        text = words(i, 60) + (" zzbad" + pick.choice(["ly", "er", ""]) + " qqvile" if toxic else "")
        rows.append((i, text if i % 100 else None, "a"))
        if i % 2:
            labels.append((i, None, int(toxic) if i % 100 else 0))
        truth = toxic and bool(i % 100)
        rows[-1] += (truth,)
    df = table(spark, [r[:3] for r in rows])
    marks = spark.createDataFrame(labels + [(None, None, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in pu_toxicity.report(df, marks).collect()}
    held = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [i for i in range(1500) if out[i].held_out] == held
    assert sum(out[i].predicted == int(rows[i][3]) for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())
    flipped = marks.withColumn("toxic", F.when(pu_toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in pu_toxicity.report(df.repartition(2), flipped).collect()}
    assert all(again[i] == pytest.approx(out[i].score, abs=1e-9) for i in out)
    assert pu_toxicity.keep_clean(df, marks).columns == df.columns
    assert pu_toxicity.report(df, marks.limit(0)).where("score > 0").count() == 0
    assert pu_toxicity.report(empty, marks.limit(0)).count() == 0


def test_pu_steps_and_scores_match_plain_loops(spark):
    import numpy as np

    pick = random.Random(12)
    docs = [sorted(pick.sample(range(12), pick.randrange(7))) for _ in range(60)]
    positive = [i % 3 == 0 for i in range(60)]
    row, col = (np.array(x) for x in zip(*[(i, f) for i, d in enumerate(docs) for f in d], strict=True))
    for prior, size in ((0.2, 0.3), (0.9, 3.0)):  # the clean risk is positive, then negative
        weights = [pick.uniform(-size, size) for f in range(13)]
        if prior > 0.5:  # all the toxic documents, and few others, are called toxic
            docs = [[*d, 12] if p else d for d, p in zip(docs, positive, strict=True)]
            row, col = (np.array(x) for x in zip(*[(i, f) for i, d in enumerate(docs) for f in d], strict=True))
            weights = [w / 9 for w in weights[:12]] + [6.0, -3.0]
        rest, plain = brute.pu_gradient(docs, positive, weights, prior, pu_toxicity.DECAY)
        assert (rest < 0) == (prior > 0.5)
        assert pu_toxicity.gradient(row, col, np.array(positive), np.array(weights), prior) == pytest.approx(plain, abs=1e-12)
    texts = [None, "", "Bad bad badly", "naïve 世界 a_b 12345678", words(1, 30_000)]
    weights = {h: pick.uniform(-1, 1) for t in texts for w in pu_toxicity._WORDS.findall((t or "").lower()) for h in pu_toxicity.features_of(w)[:2]}
    weights[pu_toxicity.BIAS] = -0.3
    import xxhash

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pu_toxicity.scores(df, weights).collect():
        logit = weights[pu_toxicity.BIAS] + sum(weights.get(xxhash.xxh64_intdigest(f) >> 1, 0.0) for f in brute.pu_features(texts[r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + np.exp(-max(-500, min(500, logit)))), abs=1e-9)


def test_frequent_values_are_all_kept():
    import numpy as np

    values = np.random.default_rng(1).zipf(1.3, 200_000) % (1 << 40)
    kept = pu_toxicity.frequent(values, 8, 1 << 10)
    names, counts = np.unique(values, return_counts=True)
    assert set(names[counts >= 8]) <= set(values[kept]) and len(pu_toxicity.frequent(values[:0])) == 0
    assert all(np.sum(values[kept] == v) == c for v, c in zip(names[counts >= 8][:50], counts[counts >= 8][:50], strict=True))


# -- SimHash ------------------------------------------------------------------------------------------------


def test_simhash(spark, docs, rows, empty):
    assert got(simhash_tiles.report(docs)) == want(brute.simhash([r[:2] for r in rows]))
    assert simhash_tiles.report(empty).count() == 0
    kept = simhash_tiles.keep_one(docs)
    groups = {c for _, _, c in brute.simhash([r[:2] for r in rows])}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == groups


def test_tiles_lose_no_link(spark, monkeypatch):
    pick = random.Random(7)
    prints = {pick.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:150]:
        for _ in range(3):
            q = p
            for _ in range(pick.randint(1, 3)):
                q ^= 1 << pick.randrange(64)
            prints.add(q)
    monkeypatch.setattr(simhash_tiles, "BLOCK", 8)  # so that tiles have several blocks
    monkeypatch.setattr(simhash_tiles, "STRIP", 4)
    prints |= {0, (1 << 64) - 1, *(1 << i for i in range(64))}
    sets = brute.Sets()
    ordered = sorted(prints)
    for i, a in enumerate(ordered):
        sets.find(a)
        for b in ordered[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                sets.join(a, b)
    found = {r.fp: r.root for r in simhash_tiles.classes(spark.createDataFrame([(simhash_tiles.signed(p),) for p in prints], "fp long")).collect()}
    assert len(found) == len(prints)
    by_root: dict = {}
    for p in ordered:
        by_root.setdefault(found[simhash_tiles.signed(p)], set()).add(sets.find(p))
    assert all(len(s) == 1 for s in by_root.values()) and len(by_root) == len({sets.find(p) for p in ordered})


# -- BPE ----------------------------------------------------------------------------------------------------


def test_bpe_matches_the_library(spark, docs, rows, empty):
    assert got(segment_bpe.digests(docs, TOKENIZER)) == want((i, *brute.bpe(TOKENIZER, t)) for i, t, _ in rows)
    assert segment_bpe.digests(empty, TOKENIZER).count() == 0


def test_bpe_on_odd_texts():
    encoder = segment_bpe.Encoder(segment_bpe.read_spec(TOKENIZER))
    pick = random.Random(8)
    alphabet = [chr(c) for c in [*range(32, 127), *range(0xC0, 0x180), *range(0x391, 0x3CA), 0x301, 0x308, 0xA0, 0x2003, 0x3000, 0x85, 9, 10, 13, 0x1C, 0x1F, 0x130, 0x1F600, 0x4E2D, 0x661, 0xFB01, 0x2028]]
    for _ in range(300):
        text = "".join(pick.choices(alphabet, k=pick.randint(0, 60))) + pick.choice(["", "<|endoftext|>", "<|startoftext|>a", "'s 'LL"])
        assert list(encoder.encode(text)) == brute._tokenizer(TOKENIZER).encode(text, add_special_tokens=False).ids, repr(text)
    word = "".join(pick.choices("abcdefghij", k=5000))
    assert list(encoder.encode(word)) == brute._tokenizer(TOKENIZER).encode(word, add_special_tokens=False).ids


# -- pipeline -----------------------------------------------------------------------------------------------


def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline
    from support import DATA

    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = scratch_path(spark, f"t-{name}")
        stage(spark, docs, sf).write.parquet(out)
        docs = spark.read.parquet(out)
        kept.append(docs.count())
        assert docs.columns == columns or name == "tokens"
    assert kept[0] == kept[1] >= kept[2] and kept[3] == kept[4] > 0
    assert docs.where("size(ids) = 0 AND decoded <> ''").count() == 0


def test_pipeline_drops_what_the_classifier_predicts(spark, monkeypatch):
    import corpus_pipeline

    docs = table(spark, [(i, str(i), "a") for i in range(10)])
    monkeypatch.setattr(corpus_pipeline, "read", lambda *_: None)
    monkeypatch.setattr(pu_toxicity, "train", lambda *_, **__: {})
    monkeypatch.setattr(pu_toxicity, "scores", lambda df, weights, text, out: df.withColumn(out, F.col("doc_id") / 10))
    kept = corpus_pipeline.toxicity(spark, docs, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 2]
