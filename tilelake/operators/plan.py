"""Planning downloads: destinations, reconciliation, budgets, batches and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilelake.functions.naming import layout_path
from tilelake.operators.catalog import ASSET_IDENTITY
from tilelake.operators.slices import row_numbers
from tilelake.schemas import STATUSES

# Fixed values of the download policy.
CONFIRM_BYTES = 5_000_000_000
DISK_MARGIN_BYTES = 1_000_000_000
MAX_BATCH, BATCH_PER_WORKER = 50, 4
ATTEMPT_LIMITS = {"mint": 2, "reauth": 2, "transfer": 6}

PART_SUFFIX = ".part"


def with_destination(assets: DataFrame, layout: str = "by_collection") -> DataFrame:
    dest = layout_path(layout)
    return assets.withColumn("dest", dest).withColumn(
        "storage_filename", F.element_at(F.split("dest", "/"), -1)
    )


def reconcile(
    assets: DataFrame,
    inventory: DataFrame,
    layout: str = "by_collection",
    overwrite: bool = False,
    mode: str = "size",
) -> DataFrame:
    """What is complete, what has to be fetched, and from which byte.

    Final and partial files of the inventory are folded into one row per destination before
    the join, so the assets are shuffled once. ``mode='existence'`` accepts any file that is
    there, whatever its size.
    """
    if mode not in ("size", "existence"):
        raise ValueError(f"unknown mode {mode!r}")
    is_part = F.col("path").endswith(PART_SUFFIX)
    present = (
        inventory.withColumn("_part", is_part)
        .groupBy(
            F.when(is_part, F.expr(f"left(path, length(path) - {len(PART_SUFFIX)})"))
            .otherwise(F.col("path")).alias("dest")
        )
        .agg(
            F.max(F.when(~F.col("_part"), F.col("length"))).alias("observed_bytes"),
            F.max(F.when(F.col("_part"), F.col("length"))).alias("part_bytes"),
        )
    )
    joined = with_destination(assets, layout).join(present, "dest", "left")
    there = F.col("observed_bytes").isNotNull()
    if mode == "existence":
        complete = there
    else:
        complete = there & F.coalesce(
            F.col("observed_bytes") == F.col("size_bytes"), F.col("size_bytes").isNull()
        )
    complete = F.lit(False) if overwrite else complete
    return joined.withColumn("is_complete", complete).withColumn(
        "resume_offset",
        F.when(F.col("is_complete"), F.lit(0).cast("bigint")).otherwise(
            F.coalesce("part_bytes", F.lit(0).cast("bigint"))
        ),
    ).withColumn("present_bytes", F.when(F.col("is_complete"), F.col("observed_bytes"))).drop(
        "observed_bytes", "part_bytes"
    )


def plan_summary(plan: DataFrame, confirm_bytes: int = CONFIRM_BYTES) -> DataFrame:
    """One row of totals, in one pass over the plan."""
    done, size = F.col("is_complete"), F.col("size_bytes")
    total = lambda when: F.coalesce(F.sum(F.when(when, size)), F.lit(0)).cast("bigint")
    return plan.agg(
        F.count_if(~done).alias("to_fetch"),
        F.count_if(done).alias("already_complete"),
        total(~done).alias("remaining_known_bytes"),
        total(done).alias("already_present_bytes"),
        total(F.lit(True)).alias("total_known_bytes"),
        F.count_if(size.isNull()).alias("unknown_size_count"),
    ).withColumn("needs_confirmation", F.col("remaining_known_bytes") > confirm_bytes)


def missing_from_batch(requested: DataFrame, returned: DataFrame) -> DataFrame:
    """Requested items a response lacks: to be asked for one by one."""
    keys = [c for c in ASSET_IDENTITY if c in requested.columns and c in returned.columns]
    return requested.join(returned.select(*keys), keys, "left_anti")


def budget_check(
    required: DataFrame, volumes: DataFrame, margin_bytes: int = DISK_MARGIN_BYTES
) -> DataFrame:
    """Needed bytes per volume against its free space; needs on one volume add up.

    A volume with nothing to write is always fine; an unknown volume never is.
    """
    needed = required.groupBy("volume").agg(F.sum("need_bytes").cast("bigint").alias("need_bytes"))
    joined = needed.join(volumes.select("volume", "free_bytes"), "volume", "left")
    return _with_verdict(joined, margin_bytes)


def _with_verdict(needs: DataFrame, margin_bytes: int) -> DataFrame:
    required = F.col("need_bytes") + margin_bytes
    fits = (F.col("need_bytes") <= 0) | (F.col("free_bytes") >= required)
    return needs.select(
        "volume", "need_bytes", "free_bytes", required.alias("required_bytes"),
        F.coalesce(fits, F.lit(False)).alias("fits"),
    )


def volume_check(
    summary: DataFrame, volumes: DataFrame, volume: str, margin_bytes: int = DISK_MARGIN_BYTES
) -> DataFrame:
    """The budget of one plan on one volume, from its one-row summary."""
    free = volumes.agg(F.max(F.when(F.col("volume") == volume, F.col("free_bytes")))).scalar()
    needs = summary.select(
        F.lit(volume).alias("volume"), F.col("remaining_known_bytes").alias("need_bytes"),
        free.alias("free_bytes"),
    )
    return _with_verdict(needs, margin_bytes)


def default_batch_size(concurrency: int = 2) -> int:
    if not 1 <= concurrency <= 4:
        raise ValueError(f"concurrency must be between 1 and 4 (got {concurrency})")
    return min(BATCH_PER_WORKER * concurrency, MAX_BATCH)


def batch_assets(
    plan: DataFrame, size: int | None = None, order: tuple[str, ...] = ("item_id", "asset_key")
) -> DataFrame:
    """Same-collection batches of at most ``size`` assets in plan order.

    Positions come from sliced row numbers, so a collection that owns most of the plan is not
    numbered in one task; a batch itself never exceeds 50 ids.
    """
    size = default_batch_size() if size is None else size
    if not 1 <= size <= MAX_BATCH:
        raise ValueError(f"batch size must be between 1 and {MAX_BATCH} (got {size})")
    slim = plan.select("collection_id", *order)
    numbered = row_numbers(slim, ["collection_id"], list(order), "position")
    batch = F.floor((F.col("position") - 1) / size).cast("bigint")
    return (
        numbered.groupBy("collection_id", batch.alias("batch_no"))
        .agg(F.array_sort(F.collect_list(F.struct("position", "item_id"))).alias("_members"))
        .select(
            "collection_id", "batch_no",
            F.col("_members.item_id").alias("item_ids"),
            F.size("_members").alias("batch_size"),
        )
    )


# -- outcomes -------------------------------------------------------------------------------


def _status_rank() -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status"))


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """Count and bytes per status, in the fixed status order."""
    return (
        outcomes.groupBy("status")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes_transferred").alias("bytes"))
        .orderBy(_status_rank())
    )


def failures(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") == "failed").select(*ASSET_IDENTITY, "dest", "error")


def latest_outcome(
    manifests: DataFrame, order: tuple[str, ...] = ("finished_at", "run_id")
) -> DataFrame:
    """The last outcome of every asset over many runs.

    The rank filter keeps one row per asset on the map side already.
    """
    w = Window.partitionBy(*ASSET_IDENTITY).orderBy(*[F.col(c).desc() for c in order])
    return (
        manifests.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")
    )


def attempt_budget(attempts: DataFrame, order: tuple[str, ...] = ("ts", "attempt_id")) -> DataFrame:
    """Number the attempts per asset and kind, and flag those beyond the limit of the kind."""
    numbered = row_numbers(attempts, [*ASSET_IDENTITY, "kind"], list(order), "attempt_no")
    limits = F.create_map(*[F.lit(v) for pair in ATTEMPT_LIMITS.items() for v in pair])
    limit = F.try_element_at(limits, F.col("kind"))
    return numbered.withColumn(
        "over_budget", F.coalesce(F.col("attempt_no") > limit, F.lit(False))
    )


def convert_summary(results: DataFrame) -> DataFrame:
    """Processed, skipped and failed tiles; bytes count for processed tiles only."""
    ok = F.col("ok") & ~F.col("skipped")
    total = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).cast("bigint")
    return results.agg(
        F.count_if(ok).alias("processed"),
        F.count_if(F.col("skipped")).alias("skipped"),
        F.count_if(~F.col("ok")).alias("failed"),
        total("input_bytes").alias("input_bytes"),
        total("output_bytes").alias("output_bytes"),
    )
