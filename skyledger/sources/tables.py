"""Table storage: Parquet folders with fixed schemas, and JDBC for tables kept in a database.

A run writes to folders `load_run=<run>`; large tables have them below the folder of a part, so a read
that is limited to some parts lists only the folders of these, however many runs there are. Facts
have months as parts (`storage_month=<month>`), dimensions have buckets of their key
(`key_bucket=<number>`): a merge reads the buckets that its rows fall into.

While a run writes, a note `_pending/<run>` stands in the table's folder, and readers leave such runs
out. A note `_done/<run>` follows. A retried run replaces its own partial output and leaves finished
output alone, so it never doubles a row and never changes a key that others may already refer to. A
table has one writer at a time. `compact` merges the runs of a part.

Gold tables are replaced part by part instead. A new state of some parts is a numbered version, and
the reader takes the newest finished version of each part. The note that finishes a version is one
file, so all its parts change at once; parts that it does not name keep their files.

For approaches the storage month is the month of the close-approach date where that date agrees with
the day in the natural key, and NULL otherwise. A row of a given key is therefore found either under
the month of its key or under NULL, and the same holds for a given date, so both merges and date
filters skip all other months without losing a row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.approach import approach_day
from skyledger.operators.numbering import dense_number, number_by_position
from skyledger.schemas import KEY_RANGE, TABLES, as_variant
from skyledger.session import (
    OPEN_WRITERS, default_setting, literal_rows, remove, staged_with, table_writer,
)

LOAD_COLUMN = "load_run"
MONTH_COLUMN = "storage_month"
BUCKET_COLUMN = "key_bucket"
KEY_BUCKETS = 64  # fixed: stored folders depend on it
OPEN_PARTS = 8  # files that a task holds open; rows of more parts are sorted by part instead
_NO_PART = "__HIVE_DEFAULT_PARTITION__"


def _agreed_approach_month() -> Column:
    day = F.col("close_approach_date")
    return F.when(approach_day(F.col("close_approach_date_full")) == day, F.trunc(day, "month"))


def _snapshot_month() -> Column:
    return F.trunc("snapshot_date", "month")


def key_bucket(key: str) -> Column:
    """Bucket of a key; a given key has the same one in every table and run."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(KEY_BUCKETS)).cast("int")


class Split(NamedTuple):
    """How a table is cut into parts: the folder column and the part of a row."""

    column: str
    kind: T.DataType
    part: Callable[[], Column]


def _by_month(part: Callable[[], Column]) -> Split:
    return Split(MONTH_COLUMN, T.DateType(), part)


def _by_key(key: str) -> Split:
    return Split(BUCKET_COLUMN, T.IntegerType(), lambda: key_bucket(key))


SPLITS: dict[str, Split] = {
    "bronze.neo_event_raw": _by_month(_agreed_approach_month),
    "bronze.satcat_raw": _by_month(_snapshot_month),
    "silver.neo": _by_key("neo_id"),
    "silver.neo_close_approach": _by_month(_agreed_approach_month),
    "silver.satcat_satellite": _by_key("norad_cat_id"),
    "silver.satcat_orbit_snapshot": _by_month(_snapshot_month),
    "gold.neo_daily_activity": _by_month(lambda: F.trunc("close_approach_date", "month")),
    "gold.neo_hazard_summary": _by_key("neo_id"),
    "gold.satcat_orbit_partial": _by_key("norad_cat_id"),
    "gold.satcat_orbit_summary": _by_key("norad_cat_id"),
    "gold.orbit_moments": _by_key("norad_cat_id"),
    "gold.ai_neo_features": _by_month(lambda: F.trunc("close_approach_date", "month")),
    "gold.ai_satcat_features": _by_month(_snapshot_month),
}
#: Tables of which the newest version of a part is read.
VERSIONED = frozenset(table for table in SPLITS if table.startswith("gold."))

#: Keys by which compaction orders the rows of a part, for lookups of single keys.
CLUSTERED_BY = {
    "silver.neo": "neo_id",
    "silver.neo_close_approach": "neo_id",
    "silver.satcat_satellite": "norad_cat_id",
    "silver.satcat_orbit_snapshot": "norad_cat_id",
}

#: Columns filled from others when rows are written, once for all readers.
DERIVED: dict[str, dict[str, Callable[[], Column]]] = {
    "bronze.satcat_raw": {"record": lambda: as_variant("parsed_record")},
}


def _hadoop(spark: SparkSession, path: str):
    """File system and path object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _hadoop(spark, path)
    return files.exists(hadoop_path)


def folder_names(spark: SparkSession, pattern: str, depth: int = 1) -> list[str]:
    """Last `depth` names of the paths that a glob pattern finds."""
    files, hadoop_path = _hadoop(spark, pattern)
    found = (f.getPath().toString() for f in files.globStatus(hadoop_path) or [])
    return sorted("/".join(path.rsplit("/", depth)[1:]) for path in found)


class Warehouse:
    """Bronze, silver, gold, meta and ml tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        schema, name = table.split(".")
        return f"{self.root}/{schema}/{name}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def finished(self, table: str, run: str) -> bool:
        """True once the run's output to this table is complete."""
        note = f"*-{run}" if table in VERSIONED else run
        return bool(folder_names(self.spark, f"{self.path(table)}/_done/{note}"))

    def _note(self, table: str, kind: str, run: str, text: str = "") -> None:
        files, note = _hadoop(self.spark, f"{self.path(table)}/_{kind}/{run}")
        out = files.create(note, True)
        out.write(bytearray(text.encode()))
        out.close()

    def loads_of(self, table: str) -> list[str]:
        """Runs that have finished their output to this table."""
        return folder_names(self.spark, f"{self.path(table)}/_done/*")

    def merged_loads(self, table: str) -> set[str]:
        """Loads of its source that the versions of a table say they hold."""
        notes = self.spark.sparkContext.wholeTextFiles
        if not self.loads_of(table):
            return set()
        text = notes(f"{self.path(table)}/_done/*").values()
        return set(text.flatMap(str.splitlines).collect())

    def _pending(self, table: str) -> list[str]:
        return folder_names(self.spark, f"{self.path(table)}/_pending/*")

    # --- reading ---

    def _part_names(self, table: str) -> list[str]:
        return folder_names(self.spark, f"{self.path(table)}/{SPLITS[table].column}=*")

    @staticmethod
    def _part_name(table: str, part: date | int | None) -> str:
        return f"{SPLITS[table].column}={_NO_PART if part is None else part}"

    def _stored(
        self,
        table: str,
        parts: Sequence[str] | None,
        without_run: str | None,
        loads: Sequence[str] | None = None,
    ) -> DataFrame:
        """The table, or some of its part folders, or what some runs loaded, with the storage
        columns."""
        schema, path = T.StructType(list(TABLES[table].fields)), self.path(table)
        if table in SPLITS:
            schema = schema.add(SPLITS[table].column, SPLITS[table].kind)
        schema = schema.add(LOAD_COLUMN, T.StringType())
        hidden = [*self._pending(table), *([without_run] if without_run is not None else [])]
        if table in VERSIONED:
            paths = [f"{path}/{p}/{v}" for p, v in self._newest(table, set(hidden), parts).items()]
        elif loads is not None:
            below = f"{SPLITS[table].column}=*/" if table in SPLITS else ""
            found = [
                f"{path}/{name}"
                for load in loads
                for name in folder_names(
                    self.spark, f"{path}/{below}{LOAD_COLUMN}={load}", 1 + (table in SPLITS)
                )
            ]
            paths = found
        else:
            paths = [path] if parts is None else [f"{path}/{part}" for part in parts]
        if not self.exists(table) or not paths:
            return literal_rows(self.spark, schema, [])
        df = self.spark.read.schema(schema).option("basePath", path).parquet(*paths)
        return df.filter(~F.col(LOAD_COLUMN).isin(*hidden)) if hidden else df

    def _newest(
        self, table: str, hidden: set[str], parts: Sequence[str] | None = None
    ) -> dict[str, str]:
        """Folder of the newest finished version of each part."""
        found = folder_names(
            self.spark, f"{self.path(table)}/{SPLITS[table].column}=*/{LOAD_COLUMN}=*", 2
        )
        newest: dict[str, str] = {}
        for part, version in (name.split("/") for name in found):  # versions come in order
            wanted = parts is None or part in parts
            if wanted and version.removeprefix(f"{LOAD_COLUMN}=") not in hidden:
                newest[part] = version
        return newest

    def stored(self, table: str, without_run: str | None = None) -> DataFrame:
        """The table with its storage columns; empty where nothing has been written.

        Runs that have not finished are left out, and so is `without_run`, for that run's retry.
        """
        return self._stored(table, None, without_run)

    def read(self, table: str, loads: Sequence[str] | None = None) -> DataFrame:
        """The table, or only the rows that the given runs loaded, whose folders alone are listed."""
        return self._stored(table, None, None, loads).select(*TABLES[table].fieldNames())

    def stored_between(
        self, table: str, first: date | None, last: date | None, without_run: str | None = None
    ) -> DataFrame:
        """Stored rows that can hold a key or a date of these days; other months are not listed."""
        no_month = f"{MONTH_COLUMN}={_NO_PART}"
        low, high = (f"{MONTH_COLUMN}={d.replace(day=1)}" if d else "" for d in (first, last))
        names = self._part_names(table)
        wanted = [m for m in names if m == no_month or (low and low <= m <= high)]
        return self._stored(table, wanted, without_run)

    def stored_parts(
        self, table: str, parts: Sequence[date | int | None], without_run: str | None = None
    ) -> DataFrame:
        """Stored rows of the given parts and of the part without a month; others are not listed."""
        wanted = {self._part_name(table, part) for part in (*parts, None)}
        names = [name for name in self._part_names(table) if name in wanted]
        return self._stored(table, names, without_run)

    def stored_for(
        self, table: str, rows: DataFrame, without_run: str | None = None
    ) -> DataFrame:
        """Stored rows of the parts that the keys of `rows` fall into.

        `rows` has the columns that decide the part and should be staged: they are read for the
        parts, of which there are KEY_BUCKETS at most for a dimension, and one per calendar month
        for a table of facts.
        """
        return self.stored_parts(table, self.parts_of(table, rows), without_run)

    def parts_of(self, table: str, rows: DataFrame) -> list[date | int | None]:
        """The parts of a table that some rows fall into, in order."""
        found = rows.select(SPLITS[table].part().alias("part")).distinct().collect()
        return sorted((r["part"] for r in found), key=lambda part: (part is not None, part))

    # --- writing ---

    def shaped(self, df: DataFrame, table: str) -> DataFrame:
        """Columns of the table in order, cast to their types; absent ones become NULL."""
        return df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in TABLES[table].fields
            ]
        )

    def append(self, df: DataFrame, table: str, run: str) -> None:
        """Write the output of one run; a second write by that run replaces the first."""
        if table in VERSIONED:
            raise ValueError(f"{table} has versions of its parts: use replace_parts or overwrite")
        self._clear(table, run)
        self._note(table, "pending", run)
        self._write(self.shaped(df, table), table, run)
        self._note(table, "done", run)
        remove(self.spark, f"{self.path(table)}/_pending/{run}")

    def find(self, table: str, value: object) -> DataFrame:
        """Rows whose clustering key has a value, wherever the table is not compacted too.

        A dimension lists the folder of one key bucket. In compacted parts, statistics and Bloom
        filters let the scan skip all row groups that do not hold the key.
        """
        key = CLUSTERED_BY[table]
        kind = TABLES[table][key].dataType
        wanted = F.lit(value).cast(kind)
        if SPLITS[table].column == BUCKET_COLUMN:
            one = literal_rows(self.spark, T.StructType().add(key, kind), [(value,)])
            rows = self.stored_for(table, one)
        else:
            rows = self.stored(table)
        return rows.filter(F.col(key) == wanted).select(*TABLES[table].fieldNames())

    def _write(self, out: DataFrame, table: str, run: str, clustered: bool = False) -> None:
        out = out.withColumn(LOAD_COLUMN, F.lit(run))
        split = [LOAD_COLUMN]
        if table in SPLITS:
            # Rebalancing splits a part that holds most rows over several writers and joins small
            # ones, so neither one huge task nor a mass of small files comes out.
            column = SPLITS[table].column
            out = out.withColumn(column, SPLITS[table].part())
            split = [column, LOAD_COLUMN]
            if clustered and table in CLUSTERED_BY:
                # Ranges of the key per file, in order inside; adaptive execution sizes them.
                order = [column, LOAD_COLUMN, CLUSTERED_BY[table]]
                out = out.repartitionByRange(column, CLUSTERED_BY[table]).sortWithinPartitions(*order)
            else:
                out = out.hint("rebalance", column)
        for name, build in DERIVED.get(table, {}).items():  # after the shuffle, which is spared them
            out = out.withColumn(name, F.coalesce(F.col(name), build()))
        writer = table_writer(out).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        if clustered and table in CLUSTERED_BY:
            writer = writer.option(f"parquet.bloom.filter.enabled#{CLUSTERED_BY[table]}", "true")
        # Rebalanced rows of a task fall into few parts, so whole rows need no sort by part.
        with default_setting(out.sparkSession, OPEN_WRITERS, str(OPEN_PARTS)):
            writer.partitionBy(*split).parquet(self.path(table))

    def _clear(self, table: str, run: str) -> None:
        """Remove what an earlier try of the run has left."""
        files, pattern = _hadoop(
            self.spark,
            f"{self.path(table)}/{SPLITS[table].column}=*/{LOAD_COLUMN}={run}"
            if table in SPLITS
            else f"{self.path(table)}/{LOAD_COLUMN}={run}",
        )
        for found in files.globStatus(pattern) or []:
            files.delete(found.getPath(), True)

    def compact(self, table: str, part: date | int | None, into: str) -> int:
        """Merge the finished runs of one part into the run `into`; returns how many there were.

        A part is named by any day of its month, or by its bucket.
        Rows stay as they are, but from then on count as loaded by `into`. For parts whose loads
        have all been processed, while nobody else reads or writes the table. A repeated call after
        a failure finishes the work: the merged rows are hidden until the old ones are gone.
        """
        name = self._part_name(table, part.replace(day=1) if isinstance(part, date) else part)
        return self._merge(table, name, into, lambda rows: rows)

    def merge_runs(
        self, table: str, into: str, fold: Callable[[DataFrame], DataFrame]
    ) -> int:
        """The same for a table without parts, whose rows `fold` may put together. The notes of the
        merged runs go with their folders, so the table must not be asked for `finished` runs."""
        old = set(self.loads_of(table)) - {into}
        merged = self._merge(table, "", into, fold)
        for run in old if merged else ():
            remove(self.spark, f"{self.path(table)}/_done/{run}")
        return merged

    def _merge(
        self, table: str, part_name: str, into: str, fold: Callable[[DataFrame], DataFrame]
    ) -> int:
        folder = f"{self.path(table)}/{part_name}".rstrip("/")
        prefix, merged = f"{LOAD_COLUMN}=", f"{self.path(table)}/_merged/{into}"
        if not path_exists(self.spark, merged):
            rows = self._stored(table, [part_name] if part_name else None, into)
            runs = rows.select(LOAD_COLUMN).distinct().count()
            if runs < 2:
                return 0
            self._clear(table, into)
            self._note(table, "pending", into)
            folded = fold(rows.select(*TABLES[table].fieldNames()))
            self._write(self.shaped(folded, table), table, into, clustered=True)
            self._note(table, "merged", into)
        hidden = {f"{prefix}{run}" for run in (*self._pending(table), into)}
        old = [n for n in folder_names(self.spark, f"{folder}/{prefix}*") if n not in hidden]
        for run_folder in old:
            remove(self.spark, f"{folder}/{run_folder}")
        self._note(table, "done", into)
        remove(self.spark, f"{self.path(table)}/_pending/{into}")
        return len(old)

    def append_keyed(
        self,
        df: DataFrame,
        table: str,
        run: str,
        key: str,
        natural_key: Sequence[str],
        rows: int | None = None,
    ) -> int:
        """Number the rows after the highest key in use, then append them. Returns the row count.

        The keys are reserved in a note of one row per table before the rows are written. So the
        highest key is known without a scan of the table, and a run that died half-way leaves a
        gap, not a double key. `df` should be staged: it is read twice, and once more for its count
        where the caller does not know it.
        """
        if rows is None:
            rows = df.count()
        base = self._reserve(table, run, key, rows)
        self.append(dense_number(df, natural_key, key, base), table, run)
        return rows

    def append_chosen(
        self,
        df: DataFrame,
        chosen: DataFrame,
        position: str,
        table: str,
        run: str,
        key: str,
        natural_key: Sequence[str],
        rows: int,
    ) -> int:
        """As `append_keyed`, for those rows of `df` whose unique `position` is in `chosen`, which has
        the natural key too. Only `chosen` is shuffled for its numbers. Both should be staged."""
        base = self._reserve(table, run, key, rows)
        numbers = dense_number(chosen, natural_key, key, base).select(position, key)
        wanted = [c for c in TABLES[table].fieldNames() if c in df.columns and c != key]
        self.append(df.select(position, *wanted).join(numbers, position), table, run)
        return rows

    def _reserve(self, table: str, run: str, key: str, rows: int) -> int:
        """Note the keys of as many rows as taken; returns the highest key before them."""
        base = self._last_key(table, key)
        reservation = literal_rows(self.spark, KEY_RANGE, [(table, run, base + rows)])
        self.append(reservation, "meta.key_range", table)
        return base

    def _last_key(self, table: str, key: str) -> int:
        note = self.stored("meta.key_range").filter(F.col(LOAD_COLUMN) == table).first()
        if note is not None:
            return note["last_key"]
        return self.read(table).agg(F.max(key)).first()[0] or 0

    def append_unkeyed_rows(
        self, df: DataFrame, table: str, run: str, key: str, same: Mapping[str, str] | None = None
    ) -> int:
        """Append rows that have no natural key. Staging fixes a row position to number them by, so
        the rows are not shuffled for their numbers, however many of them are equal. `same` names
        columns that mostly equal another one; where they do, only the other one is staged."""
        same, rows = same or {}, self.shaped(df, table)
        equal = {f"_same_{c}": F.col(c).eqNullSafe(F.col(other)) for c, other in same.items()}
        left = {c: F.when(~F.col(f"_same_{c}"), F.col(c)) for c in same}
        rows = rows.withColumns(equal).withColumns(left)
        positioned, found = staged_with(
            rows.withColumn("_row", F.monotonically_increasing_id()), rows=F.count(F.lit(1))
        )
        base = self._reserve(table, run, key, found["rows"])
        numbered = number_by_position(positioned, "_row", key, base)
        whole = {
            c: F.when(F.col(f"_same_{c}"), F.col(other)).otherwise(F.col(c))
            for c, other in same.items()
        }
        self.append(numbered.withColumns(whole), table, run)
        return found["rows"]

    def overwrite(
        self, df: DataFrame, table: str, run: str = "current", loads: Sequence[str] = ()
    ) -> None:
        """Replace the whole table."""
        if table in VERSIONED:
            self.replace_parts(df, table, run, None, loads)
        else:
            self.append(df, table, run)

    def replace_parts(
        self,
        df: DataFrame,
        table: str,
        run: str,
        parts: Sequence[date | int | None] | None,
        loads: Sequence[str] = (),
    ) -> None:
        """Put `df` in the place of some parts, or of all; other parts keep their files.

        Rows of `df` in other parts are left out. A part without rows in `df` becomes empty. `loads`
        are noted as merged, in the one file that finishes the version.
        """
        path, column = self.path(table), SPLITS[table].column
        for lost in self._pending(table):  # of a writer that did not come to its end
            self._clear(table, lost)
            remove(self.spark, f"{path}/_pending/{lost}")
        used = [int(n.split("-")[0]) for n in folder_names(self.spark, f"{path}/_done/*")]
        version = f"{max(used, default=0) + 1:08d}-{run}"
        rows = self.shaped(df, table)
        if parts is not None:
            part = SPLITS[table].part()
            known = [p for p in parts if p is not None]
            inside = part.isin(*known) if known else F.lit(False)
            if None in parts:
                inside |= part.isNull()
            rows = rows.filter(F.coalesce(inside, F.lit(False)))
        self._note(table, "pending", version)
        self._write(rows, table, version)
        names = self._part_names(table) if parts is None else [self._part_name(table, p) for p in parts]
        for name in names:
            files, folder = _hadoop(self.spark, f"{path}/{name}/{LOAD_COLUMN}={version}")
            files.mkdirs(folder)
        self._note(table, "done", version, "\n".join(loads))
        remove(self.spark, f"{path}/_pending/{version}")
        for name in names:
            for old in folder_names(self.spark, f"{path}/{name}/{LOAD_COLUMN}=*"):
                if old != f"{LOAD_COLUMN}={version}":
                    remove(self.spark, f"{path}/{name}/{old}")

    def register_views(self, tables: Sequence[str]) -> None:
        """Expose tables to SQL as temporary views named `schema_table`."""
        for table in tables:
            self.read(table).createOrReplaceTempView(table.replace(".", "_"))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Scan a database table in parallel by a partition column with its bounds.

    A table without such a column needs an explicit `partitions=1`: one connection reads it all.
    """
    if column is None and partitions != 1:
        raise ValueError("name a partition column, or ask for partitions=1")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize="10000", **options)
    if column is not None:
        reader = reader.options(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", partitions: int = 16, **options: str
) -> None:
    """Write to a database table over a bounded number of connections."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize="10000", numPartitions=str(partitions), **options)
        .mode(mode)
        .save()
    )
