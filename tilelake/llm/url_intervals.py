"""URL filters as a temporal join, in DataFrame operations only.

A dated list says from when a host, with all hosts below it, is blocked or allowed. Entries of a
key become validity intervals, each ending where the key's next entry starts. Every capture is
joined as of its fetch time with the interval of each suffix of its host that was active then, and
the longest suffix decides. The join is an equi-join on suffix and time slot with the exact bounds
as its condition, so a host with a third of all captures is one that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilelake.llm.common import fresh

SLOT_S = 30 * 86400  # seconds of a time slot
FOREVER = "9999-12-31 00:00:00"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user, port and last dot; NULL if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def suffixes(host: Column) -> Column:
    """All endings of a host at label borders, the host itself included: pairs of depth and key."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".").alias("key")))


def intervals(entries: DataFrame) -> DataFrame:
    """``key, action, valid_from, valid_to`` from ``key, action, listed_at``.

    Keys are lower-cased; entries without key, action or time are left out. Of entries of one key at
    one time, the one with the largest action stays, so that "block" beats "allow". Repeats of the
    state that holds already start no new interval of their own, but are kept as entries.
    """
    clean = entries.select(F.lower("key").alias("key"), "action", F.col("listed_at").alias("valid_from")).where(
        "key IS NOT NULL AND action IS NOT NULL AND valid_from IS NOT NULL")
    clean = clean.groupBy("key", "valid_from").agg(F.max("action").alias("action"))
    after = F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from"))
    return clean.select("key", "action", "valid_from", F.coalesce(after, F.lit(FOREVER).cast("timestamp")).alias("valid_to"))


def _slot(at: Column) -> Column:
    return F.floor(F.unix_timestamp(at) / SLOT_S)


def judge(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, time_col: str) -> DataFrame:
    """One row per capture: id, ``host``, ``fetched_at``, ``entry``, ``valid_from``, ``blocked``.

    ``captures`` are told apart by all three columns: rows that repeat them get one row each with the
    same verdict. A capture without host or time matches nothing and isn't blocked; nor is one before
    its first entry. Empty tables give no rows, or no matches. Other columns are ignored.
    """
    rows = captures.select(F.col(f"`{id_col}`").alias("id"), host_of(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{time_col}`").cast("timestamp").alias("at"))
    spans = intervals(entries)
    # An interval needs a row in each slot it touches, up to the last slot that any capture falls in:
    # the slots that captures have are few, and so are the keys of their hosts.
    asked = rows.where("host IS NOT NULL AND at IS NOT NULL").select("host", _slot(F.col("at")).alias("slot")).distinct()
    asked = asked.select("slot", F.explode(suffixes(F.col("host"))).alias("s")).select("slot", F.col("s.key").alias("key")).distinct()
    active = asked.join(spans, "key").where(
        (F.col("slot") >= _slot(F.col("valid_from"))) & (F.col("slot") <= _slot(F.col("valid_to"))))

    looked = rows.where("host IS NOT NULL AND at IS NOT NULL").groupBy("id", "host", "at").agg(F.count("*").alias("n"))
    looked = looked.select("id", "host", "at", _slot(F.col("at")).alias("slot"), F.explode(suffixes(F.col("host"))).alias("s"))
    looked = looked.select("id", "host", "at", "slot", F.col("s.depth").alias("depth"), F.col("s.key").alias("key"))
    found = (looked.join(active, ["key", "slot"]).where("at >= valid_from AND at < valid_to")
             .groupBy("id", "host", "at").agg(F.max(F.struct("depth", "key", "valid_from", "action")).alias("e")))
    found = found.select(F.col("id").alias("f_id"), F.col("host").alias("f_host"), F.col("at").alias("f_at"), "e")
    return rows.join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("host") == F.col("f_host")) & (F.col("at") == F.col("f_at")), "left").select(
        F.col("id").alias(id_col), "host", F.col("at").alias("fetched_at"), F.col("e.key").alias("entry"),
        F.col("e.valid_from").alias("valid_from"), F.coalesce(F.col("e.action") == "block", F.lit(False)).alias("blocked"))


def allowed(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, time_col: str) -> DataFrame:
    """Captures that no entry active at their fetch time blocks, with all their columns."""
    key, host, at = fresh(captures, "_b_id", "_b_host", "_b_at")
    bad = judge(captures, entries, id_col, url_col, time_col).where("blocked").select(
        F.col(id_col).alias(key), F.col("host").alias(host), F.col("fetched_at").alias(at)).distinct()
    return captures.join(bad, F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & (host_of(F.col(f"`{url_col}`")) == F.col(host))
                         & (F.col(f"`{time_col}`").cast("timestamp") == F.col(at)), "left_anti")
