"""WARC archives and their capture index, merged externally.

Captures are written as gzipped WARC 1.1 files: responses, and revisits of the response with the same
payload. The archives are read back record by record, by their content lengths. Each archive gives
a run of index entries sorted by URL key and time. The runs are dealt to ranges of the global order
by (URL key, time, id), so a URL with a third of all captures spans several ranges, and each range
merges its pieces of the k runs with a loser tree. Ranges in order are the global capture history.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.session import materialize, scratch_path

REVISIT_BYTES = 1000  # equal payloads of at least so many bytes are stored once
ARCHIVE_BYTES = 16 << 20  # payload bytes that an archive is meant to hold
RANGE_ENTRIES = 200_000  # index entries that one merging task is meant to hold

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
_END = "\r\n\r\n"


def _header_value(value: Column) -> Column:
    """A value that fits one header line: per cent, white space and control characters as %XX."""
    out = F.replace(value, F.lit("%"), F.lit("%25"))
    for code in (*range(33), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(value.rlike(r"[%\x00-\x20\x7F]"), out).otherwise(value)


def classify(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """``id, sha256, refers_to`` for pages whose payload is stored by another page.

    Of equal payloads of at least 1000 bytes the page with the largest id is the response. Payloads
    are equal when their SHA-256 is; a payload with a third of all rows is one row per task after
    the partial aggregate, and the join back to the rows is one AQE splits.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.sha2(payload, 256).alias("sha256"), F.octet_length(payload).alias("n"))
    rows = rows.where(F.col("n") >= REVISIT_BYTES)
    kept = materialize(rows.groupBy("sha256").agg(F.max("id").alias("stays"), F.count("*").alias("held")).where("held > 1").drop("held"), "payloads")
    return rows.join(kept, "sha256").where("NOT (id <=> stays)").select("id", "sha256", F.col("stays").alias("refers_to")).distinct()


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, captured: Column, archives: int) -> DataFrame:
    """The text of each page's WARC record, without the blank lines that end it, dealt to ``archives`` partitions.

    The deal by id and payload is also the one the join with the revisits needs, so payloads move once.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), _header_value(F.col(f"`{url_col}`").cast("string")).alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("sha256"), F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    named = F.coalesce(F.col("id").cast("string"), F.lit("")).alias("name")
    other = classify(pages, id_col, payload_col).select(named, "sha256", "refers_to").repartition(archives, "name", "sha256")
    rows = rows.withColumn("name", named).repartition(archives, "name", "sha256").join(other, ["name", "sha256"], "left")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(_HTTP), F.octet_length("payload").cast("string"), F.lit(_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:capture:"), F.col("name"), F.lit(">"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Date: "), F.col("date")), F.lit("")),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.col("url")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.sha1(F.encode("payload", "UTF-8")),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <urn:capture:"), F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(_END))
    return rows.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, id_col: str, url_col: str, payload_col: str, captured: Column, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write all pages under ``path``. Rows are dealt to archives by a hash of id and payload, as many
    archives as the payloads' bytes ask for; a payload larger than that has its archive to itself."""
    size = F.octet_length(F.coalesce(F.col(f"`{payload_col}`"), F.lit("")))
    total = pages.agg(F.sum(size + 400)).first()[0] or 0
    rows = records(pages, id_col, url_col, payload_col, captured, max(1, -(-total // archive_bytes)))
    # Two line ends close a record, which is what the text writer puts after each row.
    rows.write.option("lineSep", _END).option("compression", "gzip").text(path)


_LINE = re.compile(rb"([A-Za-z-]+): *([^\r\n]*)\r\n")


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of each record of an archive, framed by its content lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/1.1\r\n", at):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.decode().lower(): v.decode() for k, v in _LINE.findall(data, at, end + 2)}
        start = end + 4
        stop = start + int(headers["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} isn't as long as it says")
        yield at, headers, data[start:stop]
        at = stop + 4


def url_key(url: str) -> str:
    """Sort-friendly key of a URL: host labels from the right, then path and query; no scheme, user, port or fragment."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in map(rest.find, "/?") if i >= 0), default=len(rest))
    host = rest[:cut].rsplit("@", 1)[-1].split(":", 1)[0].lower().rstrip(".")
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:].lower() or "/")


_ENTRY = pa.schema([
    ("run", pa.string()), ("seq", pa.int64()), ("key", pa.string()), ("date", pa.string()), ("id", pa.string()), ("url", pa.string()),
    ("type", pa.string()), ("digest", pa.string()), ("bytes", pa.int64()), ("refers_to", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _run_of(path: str, data: bytes) -> pa.RecordBatch:
    """The sorted run of an archive. Digests of stored payloads are checked."""
    rows = []
    for offset, h, block in parse(data):
        head, payload = block.split(b"\r\n\r\n", 1)
        size = int(head.rsplit(b":", 1)[1])
        digest = h["warc-payload-digest"].removeprefix("sha1:")
        if h["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"{path}: the payload at byte {offset} isn't what its record says")
        url = unquote(h.get("warc-target-uri", ""))
        name = h["warc-record-id"].removeprefix("<urn:capture:").removesuffix(">")
        other = h.get("warc-refers-to")
        rows.append({
            "run": path, "key": url_key(url), "date": h.get("warc-date", ""), "id": name, "url": url, "type": h["warc-type"], "digest": digest,
            "bytes": size, "refers_to": other and other.removeprefix("<urn:capture:").removesuffix(">"), "offset": offset, "length": len(block)})
    rows.sort(key=_order)
    return pa.RecordBatch.from_pylist([r | {"seq": i} for i, r in enumerate(rows)], schema=_ENTRY)


def _order(entry: dict) -> tuple:
    return entry["key"], entry["date"], entry["id"], entry["offset"]


class LoserTree:
    """Merge of k sorted lists: each inner node keeps the loser of its match, and the winner goes on up."""

    def __init__(self, runs: list[list], order):
        self.runs, self.order, self.at = runs, order, [0] * len(runs)
        self.heads = [self._head(i) for i in range(len(runs))]
        self.losers = [-1] * len(runs)
        for i in range(len(runs)):
            self._climb(i, building=True)

    def _head(self, i: int):
        run = self.runs[i]
        return (0, self.order(run[self.at[i]]), i) if self.at[i] < len(run) else (1, (), i)

    def _climb(self, winner: int, building: bool = False) -> None:
        k = len(self.runs)
        node = (winner + k) // 2
        while node > 0:
            loser = self.losers[node]
            if building and loser < 0:
                self.losers[node] = winner
                return
            if loser >= 0 and self.heads[loser] < self.heads[winner]:
                self.losers[node], winner = winner, loser
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.runs:
            i = self.losers[0]
            if self.heads[i][0]:
                return
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self._head(i)
            self._climb(i)


def read_runs(spark, path: str) -> DataFrame:
    """Index entries of all (gzipped) archives under ``path``, sorted within each archive."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = ("run string, seq long, key string, date string, id string, url string, type string, digest string, bytes long, "
              "refers_to string, offset long, length long")

    def index(batches):
        for batch in batches:
            for name, data in zip(batch.column("path"), batch.column("content"), strict=True):
                yield _run_of(name.as_py(), gzip.decompress(data.as_py()))

    return files.mapInArrow(index, schema)


def merge_runs(runs: DataFrame, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """The entries in global order: ``shard`` and ``place`` within it give the position.

    A shard is a range of (key, date, id, run); its task merges the shard's pieces of all runs.
    """
    runs = materialize(runs, "runs")
    shards = max(1, -(-runs.count() // range_entries))
    dealt = runs.repartitionByRange(shards, "key", "date", "id", "run", "seq").withColumn("shard", F.spark_partition_id())
    pieces = dealt.sortWithinPartitions("run", "seq")
    names = pieces.columns

    def merge(batches):
        by_run: dict[str, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                by_run.setdefault(row["run"], []).append(row)
        out, place = [], 0
        for entry in LoserTree(list(by_run.values()), _order):
            out.append(entry | {"place": place})
            place += 1
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([*_ENTRY, ("shard", pa.int32()), ("place", pa.int64())])
    return pieces.mapInArrow(merge, ", ".join(f"`{n}` {dict(pieces.dtypes)[n]}" for n in names) + ", place long")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", captured: Column | None = None, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read them back, and give the merged index, one row per page.

    A null payload is an empty one. A null URL leaves out its header and sorts first; a null id is an
    empty name. Rows that repeat an id and a payload are records of their own, all responses if that
    page is the response. ``captured`` defaults to a second per id from 2024 on. An empty table gives
    no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    if captured is None:
        captured = F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce(F.pmod(F.col(f"`{id_col}`"), F.lit(1 << 30)), F.lit(0)))
    write_archives(pages, path, id_col, url_col, payload_col, captured)
    return merge_runs(read_runs(spark, path))
