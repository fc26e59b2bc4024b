"""Quality rules by cross-document line frequency.

One pass over the texts gives each document's base figures and its lines as hashes of their
normalised form. Per host, a line counts the different documents that hold it, told apart by id, or, on
request, the different texts (so that a page that was crawled often doesn't make its own lines common).
Lines in more documents than the limits allow are removed, and documents that keep too little are rejected.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import SPACES, fresh, map_columns, narrow
from tilelake.session import materialize

# Limits of the base rules and of the method.
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated three-word windows
MIN_DOCS = 20  # a line in no more documents of a host than this always stays
MAX_SHARE = 0.02  # ... as does one in no more than this share of the host's documents
MAX_DOCS = 200  # ... but one in more documents than this goes, whatever the size of the host
MIN_LEFT = 0.5  # share of its words that a document must keep
SYMBOLS = "#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    two = ids[:-1] * len(known) + ids[1:]
    _, two = np.unique(two, return_inverse=True)
    _, at, count = np.unique(two[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = count[at] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def line_key(line: bytes) -> int:
    """Signed hash of a line: A-Z lower-cased, runs of white space as one space."""
    return xxhash.xxh64_intdigest(b" ".join(line.lower().split()), 7) - (1 << 63)


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Base figures of every whole text, with its lines that hold a word as position, hash, words."""

    def work():
        def one(text: str):
            raw = text.encode()
            words = raw.split()
            lines, seen, again = [], set(), 0
            for i, line in enumerate(raw.split(b"\n")):
                if n := len(line.split()):
                    again += line in seen
                    seen.add(line)
                    lines.append({"pos": i, "h": line_key(line), "w": n})
            return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), again,
                    repeated_words(words), lines)

        def step(batch):
            rows = [one(t.as_py() or "") for t in batch["text"]]
            columns = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"),
                               map(list, zip(*rows, strict=True)) if rows else [[]] * 6, strict=True))
            return columns | {n: batch[n] for n in ("doc_id", "host", "body")}

        return step

    rows = narrow(docs, doc_id=id_col, text=text_col, host=host_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.withColumns({"host": F.col("host").cast("string"), "body": F.sha2(F.coalesce("text", F.lit("")), 256)})
    return map_columns(rows, work, f"doc_id {kind}, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                       "n_repeat_words long, body string, lines array<struct<pos: int, h: long, w: int>>")


def common_lines(profiles: DataFrame, min_docs: int, max_share: float, max_docs: int = MAX_DOCS, by: str = "documents") -> DataFrame:
    """``host, h`` of lines in more different documents (or ``by="texts"``) of a host than the limits allow: in more
    than ``max_docs``, or in more than ``min_docs`` and the share.

    Rows without an id are one document. The first shuffle is by host, line and document, so no
    line lies in one task; the second has counts only.
    """
    if by not in ("documents", "texts"):
        raise ValueError(f"counts documents or texts, not {by}")
    different = F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int")) if by == "documents" else F.count_distinct("body")
    total = profiles.groupBy("host").agg(different.alias("docs"))
    lines = profiles.select("host", "body" if by == "texts" else "doc_id", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    found = lines.groupBy("host", "h").agg(different.alias("held"))
    found = found.where(F.col("held") > min(min_docs, max_docs))
    return (found.alias("f").join(total.alias("t"), F.col("f.host").eqNullSafe(F.col("t.host")))
            .where((F.col("held") > max_docs) | ((F.col("held") > min_docs) & (F.col("held") > F.col("docs") * max_share))).select("f.host", "f.h"))


def verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT, max_docs: int = MAX_DOCS,
    by: str = "documents",
) -> DataFrame:
    """One row per document: base figures, ``removed`` line positions, words left, and ``kept``.

    A null text is an empty one; a null host is a host of its own. Empty texts fail the base rule.
    Very long texts are read whole. Repeated rows each get the same verdict and count once, as do all rows with a null id
    or, for ``by="texts"``, all rows with one text. An empty table gives no rows; other columns are
    ignored. A document is rejected if a base rule fails or if, after removal, it has fewer than
    50 words or less than ``min_left`` of its words.
    """
    rows = materialize(profile(docs, id_col, text_col, host_col), "lines")
    bad = materialize(common_lines(rows, min_docs, max_share, max_docs, by), "common-lines")
    # One row per different text of a host: copies have the same lines.
    lines = rows.select("host", "body", F.explode("lines").alias("x")).select("host", "body", "x.*")
    lines = lines.select(F.coalesce(F.concat(F.lit("="), "host"), F.lit("")).alias("at"), "body", "pos", "h", "w")
    bad = bad.select(F.coalesce(F.concat(F.lit("="), "host"), F.lit("")).alias("at"), "h")
    gone = (lines.join(bad, ["at", "h"]).groupBy("at", "body").agg(
        F.sort_array(F.collect_set("pos")).alias("removed"), F.collect_set(F.struct("pos", "w")).alias("_w")))
    gone = gone.select("at", "body", "removed", F.aggregate("_w", F.lit(0).cast("long"), lambda a, x: a + x["w"]).alias("lost"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return (
        rows.drop("lines").withColumn("at", F.coalesce(F.concat(F.lit("="), "host"), F.lit("")))
        .join(gone, ["at", "body"], "left")
        .select("doc_id", "host", "body", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                failed.alias("base_failed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"), left.alias("words_left"),
                (~failed & (left >= MIN_WORDS) & (left >= min_left * F.col("n_words"))).alias("kept")))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """Kept documents with their common lines taken out; all columns of ``docs`` stay."""
    key, host, body, removed = fresh(docs, "_v_id", "_v_host", "_v_body", "_v_removed")
    found = verdicts(docs, id_col, text_col, host_col, **limits).where("kept").select(
        F.col("doc_id").alias(key), F.col("host").alias(host), F.col("body").alias(body), F.col("removed").alias(removed)).distinct()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.join(
        found, F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & F.col(f"`{host_col}`").cast("string").eqNullSafe(F.col(host))
        & (F.sha2(text, 256) == F.col(body)))
    cut = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(F.col(removed), i)), "\n")
    return rows.select(*(cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
