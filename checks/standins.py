"""Bronze inputs derived from the driver's tables.

Orders stand for close approaches (customers are the objects, partly delivered orders arrive a
second time under another name), line items stand for catalog snapshots (parts are the
satellites). Each input keeps every row of its tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.ledger import run_state
from skyledger.plans import silver_neo, silver_satcat
from skyledger.session import bound_splits, staged

ROW_GROUP_BYTES = 128 << 20  # what writers put into a row group at most
GROUPS_PER_CORE = 2  # so that no core has much more of them than another
REDELIVERED_OFFSET = 1_000_000_000_000


def _text(column: Column, scale: int) -> Column:
    """Number as text by way of a decimal, so that its form is the same everywhere."""
    return column.cast(f"decimal(18,{scale})").cast("string")


def _json(**members: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in members.items()]))


class Inputs:
    """Lazily built frames over the tables in one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        bound_splits(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rows(self, name: str) -> DataFrame:
        """A table whose rows are worked on one by one, dealt over all cores.

        A scan cannot split a row group, so a file of one group would keep one core busy. Tables with
        groups for every core are left as they are, which spares their rows a shuffle.
        """
        df = self.table(name)
        cores = self.spark.sparkContext.defaultParallelism
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size >= cores * ROW_GROUP_BYTES or self._has_row_groups(df, GROUPS_PER_CORE * cores):
            return df
        return df.repartition(cores)

    def _has_row_groups(self, df: DataFrame, wanted: int) -> bool:
        """Whether the files of a table have that many row groups, by their footers."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        parquet = jvm.org.apache.parquet.hadoop
        for name in df.inputFiles():
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
            reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(path, conf))
            wanted -= reader.getRowGroups().size()
            reader.close()
            if wanted <= 0:
                return True
        return False

    # --- approaches ---

    @cached_property
    def deliveries(self) -> DataFrame:
        """Orders with their customer; partly delivered orders come twice (`copy` 0 and 1)."""
        copies = F.when(F.col("o_orderstatus") == "P", F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        orders = self.rows("orders").select("*", F.explode(copies).alias("copy"))
        customers = self.table("customer")
        return orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "inner")

    @cached_property
    def bronze_neo(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        minute = F.col("o_orderkey") % 1440
        moment = F.col("o_orderdate") + F.make_dt_interval(mins=minute.cast("int"))
        diameter = F.abs(F.col("c_acctbal")).cast("decimal(18,2)")
        speed = F.lit(200) + F.col("o_orderkey") % 7000  # km/s in hundredths
        km = F.col("o_totalprice").cast("decimal(18,2)")
        neo_id = F.col("c_custkey").cast("string")
        marker = F.when(
            F.col("o_orderpriority") == "5-LOW",
            F.concat(F.lit('{"id":"'), neo_id, F.lit('","_synthetic":true}')),
        ).otherwise(F.concat(F.lit('{"id":"'), neo_id, F.lit('"}')))
        return self.deliveries.select(
            (F.col("o_orderkey") + F.col("copy") * F.lit(REDELIVERED_OFFSET)).alias("event_id"),
            moment.alias("ingestion_timestamp"),
            day.alias("feed_start_date"),
            F.date_add(day, 6).alias("feed_end_date"),
            neo_id.alias("neo_id"),
            neo_id.alias("neo_reference_id"),
            F.when(F.col("copy") == 1, F.concat("c_name", F.lit(" (R)")))
            .otherwise(F.col("c_name"))
            .alias("neo_name"),
            (F.col("c_mktsegment") == "MACHINERY").alias("is_potentially_hazardous_asteroid"),
            ((F.col("c_custkey") % 2500).cast("double") / 100.0 + 10.0).alias(
                "absolute_magnitude_h"
            ),
            F.concat(
                F.lit('{"kilometers":{"estimated_diameter_min":'),
                diameter.cast("string"),
                F.lit(',"estimated_diameter_max":'),
                (diameter * 2).cast("string"),
                F.lit("}}"),
            ).alias("estimated_diameter"),
            day.alias("close_approach_date"),
            F.date_format(moment, "yyyy-MMM-dd HH:mm").alias("close_approach_date_full"),
            (
                F.date_diff(day, F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000
                + minute * 60_000
            ).alias("epoch_date_close_approach"),
            _json(
                kilometers_per_second=_text(speed.cast("double") / 100.0, 2),
                kilometers_per_hour=(speed * 36).cast("string"),
                miles_per_hour=(
                    (speed * 36).cast("decimal(18,0)") * F.lit("0.621371").cast("decimal(6,6)")
                ).cast("string"),
            ).alias("relative_velocity"),
            _json(
                astronomical=(km * F.lit("0.000000006684587").cast("decimal(15,15)")).cast("string"),
                lunar=F.when(F.col("o_orderkey") % 97 == 0, F.lit("")).otherwise(
                    _text(F.col("o_totalprice") / 3844.0, 6)
                ),
                kilometers=km.cast("string"),
                miles=(km * F.lit("0.621371").cast("decimal(6,6)")).cast("string"),
            ).alias("miss_distance"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Moon"))
            .otherwise(F.lit("Earth"))
            .alias("orbiting_body"),
            marker.alias("raw_neo"),
        )

    # --- catalog ---

    @cached_property
    def bronze_satcat(self) -> DataFrame:
        lines, parts = self.rows("lineitem"), self.table("part")
        joined = lines.join(parts, lines["l_partkey"] == parts["p_partkey"], "inner")
        size = F.col("p_size").cast("long")
        quantity = F.col("l_quantity").cast("long")
        is_geo, is_heo = F.col("p_brand") == "Brand#1", F.col("p_brand") == "Brand#2"
        apogee = F.when(is_geo, 35786 + quantity).otherwise(size * 800 + quantity * 10)
        perigee = F.when(is_geo, 35786 - quantity).when(is_heo, F.lit(500)).otherwise(size * 700)
        inclination = F.col("l_discount") * F.when(is_geo, 50.0).otherwise(1000.0)
        record = _json(
            NORAD_CAT_ID=F.when(F.col("l_orderkey") % 1000 == 0, F.lit("")).otherwise(
                F.col("p_partkey").cast("string")
            ),
            OBJECT_ID=F.concat(F.lit("1998-"), F.col("p_partkey").cast("string")),
            OBJECT_NAME=F.col("p_name"),
            OBJECT_TYPE=F.col("p_type"),
            OWNER=F.col("p_brand"),
            OPS_STATUS_CODE=F.col("l_linestatus"),
            LAUNCH_DATE=F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(
                F.lit("1998-01-02")
            ),
            DECAY_DATE=F.when(F.col("l_returnflag") == "R", F.lit("2024-13-45")).otherwise(
                F.lit("")
            ),
            ORBIT_CENTER=F.lit("EA"),
            RCS=F.when(size % 5 == 0, F.lit("")).otherwise(size.cast("string")),
            PERIOD=F.when(size % 11 == 0, F.lit("n/a")).otherwise(
                _text((90 + size * 20).cast("double") + F.col("l_tax") * 100.0, 2)
            ),
            INCLINATION=_text(inclination, 2),
            APOGEE=apogee.cast("string"),
            PERIGEE=perigee.cast("string"),
        )
        return joined.select(
            (
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100_000_000
                + F.col("l_partkey")
            ).alias("id"),
            F.col("l_shipdate").alias("ingestion_timestamp"),
            F.when(F.col("l_linenumber") == 7, F.lit("all"))
            .otherwise(F.lit("active"))
            .alias("snapshot_group"),
            F.col("l_shipdate").cast("date").alias("snapshot_date"),
            F.col("p_name").alias("raw_csv_row"),
            record.alias("parsed_record"),
        )

    # --- silver ---

    @cached_property
    def neo(self) -> DataFrame:
        return silver_neo.build_neo(self.bronze_neo)

    @cached_property
    def approaches(self) -> DataFrame:
        return silver_neo.build_approaches(self.bronze_neo, self.neo)

    @cached_property
    def satellites(self) -> DataFrame:
        return silver_satcat.build_satellites(self.records)

    @cached_property
    def snapshots(self) -> DataFrame:
        return silver_satcat.build_snapshots(self.records, self.satellite_keys)

    @cached_property
    def satellite_keys(self) -> DataFrame:
        """Keys of the satellites; their attributes are built for queries that use them."""
        if "satellites" in self.__dict__:
            return self.satellites
        return silver_satcat.satellite_keys(self.records)

    # The same rows without surrogate keys, for queries that return none.

    @cached_property
    def objects(self) -> DataFrame:
        return silver_neo.neo_candidates(self.bronze_neo)

    @cached_property
    def facts(self) -> DataFrame:
        return silver_neo.approach_candidates(self.bronze_neo)

    @cached_property
    def records(self) -> DataFrame:
        """Typed records, staged: their JSON is built and parsed once for all that read them."""
        return staged(silver_satcat.parse_records(self.bronze_satcat))

    @cached_property
    def catalog(self) -> DataFrame:
        return silver_satcat.satellite_candidates(self.records)

    @cached_property
    def orbits(self) -> DataFrame:
        return silver_satcat.snapshot_candidates(self.records)

    # --- ledger ---

    @cached_property
    def run_events(self) -> DataFrame:
        """Each order is a run that starts on its date; those delivered have ended."""
        key = F.col("o_orderkey")
        start = F.col("o_orderdate") + F.make_dt_interval(mins=(key % 1440).cast("int"))
        end = start + F.make_dt_interval(mins=(key % 90 + 1).cast("int"))
        status = F.col("o_orderstatus")
        started = F.struct(
            F.lit("start").alias("event"),
            start.alias("event_time"),
            F.lit("running").alias("status"),
            F.lit(None).cast("long").alias("records_processed"),
            F.lit(None).cast("string").alias("error_message"),
        )
        ended = F.struct(
            F.lit("end").alias("event"),
            end.alias("event_time"),
            F.when(status == "F", F.lit("failed")).otherwise(F.lit("success")).alias("status"),
            F.col("o_custkey").alias("records_processed"),
            F.when(status == "F", F.lit("boom")).alias("error_message"),
        )
        events = F.when(status == "O", F.array(started)).otherwise(F.array(started, ended))
        return self.table("orders").select(
            key.cast("string").alias("run_id"),
            F.col("o_orderpriority").alias("pipeline_name"),
            F.lit("scheduler").alias("triggered_by"),
            F.lit(None).cast("string").alias("dag_id"),
            F.lit(None).cast("string").alias("task_id"),
            F.explode(events).alias("e"),
        ).select("run_id", "pipeline_name", "triggered_by", "dag_id", "task_id", "e.*")

    @cached_property
    def runs(self) -> DataFrame:
        return run_state(self.run_events)
