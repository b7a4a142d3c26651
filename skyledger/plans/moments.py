"""Anomaly scores of new snapshots without the history: moments of the deltas, kept per satellite.

Per satellite and element, the table `gold.orbit_moments` has count, mean and the sum of squared
deviations (M2) of all deltas so far, and the elements of the last snapshot. A load gives deltas
against these last elements, its own moments are merged into the stored ones in one step, and the
scores of the load follow from the merged moments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.schemas import MOMENT_ELEMENTS, ORBIT_MOMENTS
from skyledger.session import staged
from skyledger.sources.tables import Warehouse

FACTS, MOMENTS = "silver.satcat_orbit_snapshot", "gold.orbit_moments"


def new_deltas(snapshots: DataFrame, state: DataFrame) -> DataFrame:
    """(norad_cat_id, snapshot_date, elements, delta_*) of snapshots that follow the stored last ones.

    The first snapshot of a satellite has NULL deltas. A snapshot that is not later than the stored
    last one of its satellite has no row: its deltas would change those that were merged before.
    """
    columns = ["norad_cat_id", "snapshot_date", *MOMENT_ELEMENTS]
    last = state.select(
        "norad_cat_id",
        F.col("last_snapshot_date").alias("snapshot_date"),
        *[F.col(f"last_{c}").alias(c) for c in MOMENT_ELEMENTS],
        F.lit(False).alias("is_new"),
    )
    rows = snapshots.select(*columns, F.lit(True).alias("is_new")).unionByName(last)
    # One row per day and satellite at most, so no window grows with the table. Both windows have one
    # order, so the rows are sorted once.
    history = Window.partitionBy("norad_cat_id").orderBy("snapshot_date")
    whole = history.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = F.max(F.when(~F.col("is_new"), F.col("snapshot_date"))).over(whole)
    rows = rows.withColumn("known", known).filter(
        ~F.col("is_new") | F.col("known").isNull() | (F.col("snapshot_date") > F.col("known"))
    )
    deltas = [(F.col(c) - F.lag(c).over(history)).alias(f"delta_{c}") for c in MOMENT_ELEMENTS]
    return rows.select("is_new", *columns, *deltas).filter("is_new").drop("is_new")


def moments_of(deltas: DataFrame) -> DataFrame:
    """Moments over some deltas, and the last elements among their snapshots."""
    parts = []
    for c in MOMENT_ELEMENTS:
        delta = F.col(f"delta_{c}")
        parts += [
            F.max_by(c, "snapshot_date").alias(f"last_{c}"),
            F.count(delta).alias(f"n_{c}"),
            F.avg(delta).alias(f"mean_{c}"),
            (F.var_pop(delta) * F.count(delta)).alias(f"m2_{c}"),
        ]
    grouped = deltas.groupBy("norad_cat_id").agg(
        F.max("snapshot_date").alias("last_snapshot_date"), *parts
    )
    return grouped.select(*ORBIT_MOMENTS.fieldNames())


def merged_moments(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Moments over both sets of deltas (Chan et al. 1983); `new` has the later snapshots."""
    a, b = stored.alias("a"), new.alias("b")
    joined = a.join(b, F.col("a.norad_cat_id") == F.col("b.norad_cat_id"), "full")
    zero = F.lit(0.0)

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"b.{name}"), F.col(f"a.{name}"))

    columns = [either("norad_cat_id").alias("norad_cat_id"), either("last_snapshot_date").alias("last_snapshot_date")]
    for c in MOMENT_ELEMENTS:
        n_a, n_b = (F.coalesce(F.col(f"{s}.n_{c}"), F.lit(0).cast("long")) for s in "ab")
        mean_a, mean_b = (F.coalesce(F.col(f"{s}.mean_{c}"), zero) for s in "ab")
        m2_a, m2_b = (F.coalesce(F.col(f"{s}.m2_{c}"), zero) for s in "ab")
        apart = mean_b - mean_a
        mean = F.when(n_a == 0, F.col(f"b.mean_{c}")).when(n_b == 0, F.col(f"a.mean_{c}")).otherwise(
            mean_a + apart * n_b / (n_a + n_b)
        )
        spread = F.when((n_a > 0) & (n_b > 0), apart * apart * n_a * n_b / (n_a + n_b)).otherwise(zero)
        # The last elements come whole from the later snapshot, also where they are NULL.
        last = F.when(F.col("b.norad_cat_id").isNotNull(), F.col(f"b.last_{c}")).otherwise(
            F.col(f"a.last_{c}")
        )
        columns += [
            last.alias(f"last_{c}"),
            (n_a + n_b).alias(f"n_{c}"),
            mean.alias(f"mean_{c}"),
            (m2_a + m2_b + spread).alias(f"m2_{c}"),
        ]
    return joined.select(*columns)


def scores(deltas: DataFrame, moments: DataFrame) -> DataFrame:
    """Z-score of each delta to 6 decimals, and the largest; NULL where deltas never vary."""
    joined = deltas.join(moments.drop(*[f"last_{c}" for c in MOMENT_ELEMENTS]), "norad_cat_id")
    columns = []
    for c in MOMENT_ELEMENTS:
        n = F.col(f"n_{c}")
        deviation = F.when(n > 1, F.sqrt(F.col(f"m2_{c}") / (n - 1)))
        z = (F.col(f"delta_{c}") - F.col(f"mean_{c}")) / F.nullif(deviation, F.lit(0.0))
        columns.append(F.round(z, 6).alias(f"z_{c}"))
    scored = joined.select("norad_cat_id", "snapshot_date", *columns)
    largest = F.greatest(*[F.abs(F.col(f"z_{c}")) for c in MOMENT_ELEMENTS])
    return scored.withColumn("anomaly_score", largest)


def score_new_snapshots(warehouse: Warehouse, run: str) -> DataFrame:
    """Scores of the snapshots that silver has loaded since the last call; merges their moments.

    Only the new snapshots and the moments of their key buckets are read. Loads must come in the
    order of their days: a snapshot not later than the last one known of its satellite gets no score
    and leaves the moments as they are. Calling it again for the same run gives no rows.
    """
    merged = warehouse.merged_loads(MOMENTS)
    loads = [load for load in warehouse.loads_of(FACTS) if load not in merged]
    new = warehouse.read(FACTS, loads)
    parts = warehouse.parts_of(MOMENTS, new)
    state = warehouse.stored_parts(MOMENTS, parts).select(*ORBIT_MOMENTS.fieldNames())
    deltas = staged(new_deltas(new, state))
    together = staged(merged_moments(state, moments_of(deltas)))
    if parts:
        warehouse.replace_parts(together, MOMENTS, run, parts, loads)
    return scores(deltas, together)
