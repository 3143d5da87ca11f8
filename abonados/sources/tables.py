"""Storing and scanning the tables of a layer."""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from abonados.sources.versions import Versions

#: Stored bytes of raw documents for each bucket of the tables made from them.
BUCKET_BYTES = 128 << 20
#: Buckets of small tables, and of the largest: one file each, as many as Spark accepts.
LEAST_BUCKETS, MOST_BUCKETS = 16, 100_000
#: Table property that holds a load's layout.
LAYOUT = "abonados.layout"
#: Keys that the sketch of rows per key looks for.
HOT_KEYS = 16
#: A bucket is uneven if its hottest key alone has more than so many buckets' share.
UNEVEN = 2.0
#: Folder column of sliced tables, and the most slices: each holds whole buckets.
SLICE = "_slice"
MOST_SLICES = 256


def buckets_for(stored_bytes: int) -> int:
    """Buckets for tables made from so many bytes; neither cores nor shuffle settings count."""
    return min(max(math.ceil(stored_bytes / BUCKET_BYTES), LEAST_BUCKETS), MOST_BUCKETS)


def slice_of(key: str, buckets: int) -> Column:
    """The slice of a key's bucket (Spark's bucket is this hash by the number of buckets)."""
    return F.pmod(F.pmod(F.hash(F.col(key)), F.lit(buckets)), F.lit(MOST_SLICES))


def folder_of(load: str) -> str:
    """The folder that holds a load's files: a revision ``table__base_mark`` shares that of
    its base, ``table__base``."""
    return re.sub(r"(__[0-9a-f]{32})_[0-9a-f]+$", r"\1", load)


@dataclass(frozen=True)
class Layout:
    """How a load was laid out: ``hottest`` is about how many rows the key with most rows
    has, which share one bucket however many there are."""

    key: str
    buckets: int
    rows: int
    hottest: int

    @property
    def uneven(self) -> bool:
        """Whether the hottest key outgrows the even share of a bucket."""
        return self.hottest * self.buckets > UNEVEN * max(self.rows, 1)


@contextmanager
def _shuffled_into(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """While it lasts, shuffles have so many partitions: each is one bucket then."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if partitions:
        spark.conf.set(key, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass
class Publication:
    """What a block of ``publishing`` wrote: loads of tables, and texts of views."""

    loads: dict[str, str] = field(default_factory=dict)
    views: dict[str, str] = field(default_factory=dict)
    kept: tuple[str, ...] = ()

    def keep_only(self, *tables: str) -> None:
        """If the block fails these tables are published all the same: reports about it."""
        self.kept = tables

    def drop_all_but(self, tables: tuple[str, ...]) -> None:
        self.loads = {table: load for table, load in self.loads.items() if table in tables}
        self.views = {}


class LayerStore:
    """Catalog tables, one database per layer, files below one root folder.

    A write goes to a new folder and table; then a version of the layer is committed that
    names it, and a view of the plain name is pointed at it. Readers see the old contents
    until the new ones are whole, and a failed write leaves the old ones in place. Tables
    written in a block of ``publishing`` become current together, in one version.
    Replaced tables stay until ``drop_replaced`` or ``remove_replaced`` is called.

    ``read`` goes by the version. Views in the catalog follow it one by one; if a writer
    ended in between, ``follow_version`` (any next write does it) points them all.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "public",
        buckets: int | None = None,
        sized_by: tuple[str, str] | None = None,
    ):
        """Tables are bucketed if ``buckets`` gives a number, or ``sized_by`` the layer and
        name of the table whose stored bytes decide: all tables made from it agree."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.buckets = buckets
        self.sized_by = sized_by
        self._counts: dict[tuple[str, str], dict[str, int]] = {}
        self._open: dict[str, Publication] = {}

    def versions(self, layer: str) -> Versions:
        return Versions(self.spark, f"{self.root}/{layer}")

    @contextmanager
    def publishing(self, layer: str) -> Iterator[Publication]:
        """Tables and views of the layer written in the block become current together when
        it ends. If it fails none does, but for tables that ``keep_only`` names. Within
        the block this store reads what it wrote. Blocks of a layer do not nest: an inner
        one is part of the outer one."""
        if layer in self._open:
            yield self._open[layer]
            return
        block = self._open[layer] = Publication()
        try:
            yield block
        except BaseException:
            block.drop_all_but(block.kept)
            raise
        finally:
            del self._open[layer]
            if block.loads:
                self.versions(layer).commit(block.loads)
                self.follow_version(layer)
            for name, text in block.views.items():
                self._create_view(layer, name, text)

    def follow_version(self, layer: str) -> None:
        """Points the view of each table at its load in the current version."""
        for table, load in self.versions(layer).current().items():
            if self.spark.catalog.tableExists(self.name(layer, load)) and self._pointed_at(layer, table) != load:
                shown = ", ".join(f"`{c}`" for c in self._columns_of(self.spark.table(self.name(layer, load))))
                self.spark.sql(
                    f"CREATE OR REPLACE VIEW {self.name(layer, table)} AS SELECT {shown} FROM {self.name(layer, load)}"
                )

    def create_view(self, layer: str, name: str, text: str) -> None:
        """Stores a view as SQL text, which outlives the session and follows its tables. In
        a block of ``publishing`` it is created when the block ends."""
        if layer in self._open:
            self._open[layer].views[name] = text
        else:
            self._create_view(layer, name, text)

    def _create_view(self, layer: str, name: str, text: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, name)} AS {text}")
        # its plain name for this session, by text too: it is resolved anew in each query
        self.spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {self.name(layer, name)}")

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        written = layer in self._open and table in self._open[layer].loads
        return written or self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """A table as the current version has it, or an earlier one that is still kept."""
        load = self._load(layer, table) if version is None else self.versions(layer).loads(version)[table]
        return self.spark.table(self.name(layer, load or table)).drop(SLICE)

    @staticmethod
    def _columns_of(df: DataFrame) -> list[str]:
        return [c for c in df.columns if c != SLICE]

    def _load(self, layer: str, table: str) -> str | None:
        if layer in self._open and table in self._open[layer].loads:
            return self._open[layer].loads[table]
        load = self.versions(layer).current().get(table)
        return load if load and self.spark.catalog.tableExists(self.name(layer, load)) else None

    def write(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        bucket_by: str | None = None,
        gather: bool = False,
        counted: dict[str, Column] | None = None,
        sliced: bool = False,
    ) -> DataFrame:
        """Full refresh. With buckets, later joins on the column need no shuffle.

        Shuffles of the write have one partition for each bucket, so a frame that is
        partitioned by the column writes one file for each. One that is not is to be
        ``gathered`` first. The layout is kept with the table.

        ``counted`` names conditions; how many rows fulfil each is observed while they are
        written, and ``counts`` tells it.

        ``sliced`` puts buckets into a folder each, or into at most ``MOST_SLICES`` of
        them, so that rows can be deleted later by writing only the slices they are in.
        """
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} LOCATION '{self.root}/{layer}'"
        )
        load = f"{table}__{uuid.uuid4().hex}"
        self._counts.pop((layer, table), None)
        observed = Observation()
        if counted:
            tests = [F.count_if(test).alias(name) for name, test in counted.items()]
            df = df.observe(observed, *tests)
        buckets = self.bucket_count() if bucket_by else None
        if buckets and gather:
            df = df.repartition(buckets, bucket_by)
        self._save(layer, load, df, load, bucket_by, buckets, sliced)
        if counted:
            self._counts[layer, table] = observed.get
        with self.publishing(layer) as block:
            block.loads[table] = load
        return self.read(layer, table)

    def _save(
        self, layer: str, load: str, df: DataFrame, folder: str, bucket_by: str | None, buckets: int | None, sliced: bool
    ) -> None:
        """Writes a frame as the catalog table of a load, its files below a folder of the layer."""
        if buckets and sliced:
            df = df.withColumn(SLICE, slice_of(bucket_by, buckets))
        writer = df.write.format("parquet").option("path", f"{self.root}/{layer}/{folder}")
        if buckets:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
            writer = writer.partitionBy(SLICE) if sliced else writer
        with _shuffled_into(self.spark, buckets):
            writer.saveAsTable(self.name(layer, load))
        if buckets:
            self._keep_layout(layer, load, bucket_by, buckets)

    def delete_orphans(self, layer: str, table: str, parent: str, column: str) -> int:
        """Deletes the rows of a sliced table whose key no row of ``parent`` has, as a
        cascading foreign key would; null keys stay. Returns how many rows went.

        One scan finds the slices that hold orphans, without a shuffle where both tables
        share buckets. Only these are written anew, beside the old ones; the new revision
        takes all other slices from where they are. It becomes current like any load, and
        earlier versions stay readable. Without orphans nothing is written.
        """
        base = self.current_load(layer, table)
        layout = self.layout(layer, table)
        children = self.spark.table(self.name(layer, base))
        if layout is None or SLICE not in children.columns:
            raise ValueError(f"{self.name(layer, table)} is not stored in slices")
        known = self.read(layer, parent).select(F.col(column)).filter(F.col(column).isNotNull())
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")
        marked = children.select(column, SLICE, folder).join(
            known.withColumn("known", F.lit(True)), column, "left"
        )
        orphan = F.col("known").isNull() & F.col(column).isNotNull()
        # a row per slice
        slices = marked.groupBy(SLICE, "folder").agg(F.count_if(orphan).alias("orphans")).collect()
        touched = [r[SLICE] for r in slices if r["orphans"]]
        if not touched:
            return 0
        held = children.filter(F.col(SLICE).isin(touched))
        rest = held.join(known, column, "left_semi").unionByName(held.filter(F.col(column).isNull()))
        mark = uuid.uuid4().hex
        load = f"{folder_of(base)}_{mark}"
        rest = rest.select(*self._columns_of(children)).repartition(layout.buckets, layout.key)
        self._save(layer, load, rest, f"{folder_of(base)}/_revision_{mark}", layout.key, layout.buckets, True)
        places = [f"PARTITION ({SLICE} = {r[SLICE]}) LOCATION '{r['folder']}'" for r in slices if not r["orphans"]]
        if places:
            self.spark.sql(f"ALTER TABLE {self.name(layer, load)} ADD {' '.join(places)}")
            self._keep_layout(layer, load, layout.key, layout.buckets)
        with self.publishing(layer) as block:
            block.loads[table] = load
        return sum(r["orphans"] for r in slices)

    def bucket_count(self) -> int | None:
        """Buckets of tables that are written now; None for none."""
        if self.buckets or not self.sized_by or not self.exists(*self.sized_by):
            return self.buckets
        return buckets_for(self.stored_bytes(*self.sized_by))

    def current_load(self, layer: str, table: str) -> str:
        """The load that readers of a table see."""
        load = self._load(layer, table) or self._pointed_at(layer, table)
        if load is None:
            raise LookupError(f"{self.name(layer, table)} is not stored")
        return load

    def _pointed_at(self, layer: str, table: str) -> str | None:
        if not self.spark.catalog.tableExists(self.name(layer, table)):
            return None
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}")
        text = described.filter("col_name = 'View Text'").first()["data_type"]
        return re.search(rf"{re.escape(table)}__[0-9a-f_]+", text).group()

    def stored_bytes(self, layer: str, table: str) -> int:
        """Bytes of the files in the current load's folder, as the file system sums them up."""
        folder = folder_of(self.current_load(layer, table))
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{layer}/{folder}")
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return files.getContentSummary(path).getLength()

    def _keep_layout(self, layer: str, load: str, key: str, buckets: int) -> None:
        # reads the one column that was written last; the sketch has a fixed size
        stored = self.spark.table(self.name(layer, load)).filter(F.col(key).isNotNull())
        row = stored.agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(`{key}`, {HOT_KEYS})").alias("hot")).first()
        layout = Layout(key, buckets, row["rows"], max((hot["count"] for hot in row["hot"]), default=0))
        kept = json.dumps(asdict(layout)).replace("'", "")
        self.spark.sql(f"ALTER TABLE {self.name(layer, load)} SET TBLPROPERTIES ('{LAYOUT}' = '{kept}')")

    def layout(self, layer: str, table: str) -> Layout | None:
        """The current load's layout; None for tables without buckets."""
        load = self.name(layer, self.current_load(layer, table))
        kept = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {load}").collect()}
        return Layout(**json.loads(kept[LAYOUT])) if LAYOUT in kept else None

    def counts(self, layer: str, table: str) -> dict[str, int] | None:
        """What was observed when this store last wrote the table; None if nothing was."""
        return self._counts.get((layer, table))

    def replace_unless_empty(self, layer: str, table: str, df: DataFrame) -> bool:
        """Full refresh that keeps the old contents if there is nothing to load."""
        if df.isEmpty():
            return False
        self.write(layer, table, df)
        return True

    def loads(self, layer: str, table: str) -> list[str]:
        """Names of all stored loads of a table, the current one included."""
        tables = self.spark.catalog.listTables(self.database(layer))
        return [t.name for t in tables if t.name.startswith(f"{table}__") and t.tableType != "VIEW"]

    def drop_replaced(self, layer: str, table: str) -> list[str]:
        """Takes earlier loads out of the catalog; their folders are returned for removal,
        but for the one that the current load shares."""
        current, gone = self.current_load(layer, table), set()
        for load in self.loads(layer, table):
            if load != current:
                self.spark.sql(f"DROP TABLE {self.name(layer, load)}")
                gone.add(folder_of(load))
        return [f"{self.root}/{layer}/{folder}" for folder in sorted(gone - {folder_of(current)})]

    def remove_replaced(self, layer: str, keep: int = 1, older_than: float = 86_400.0) -> list[str]:
        """Removes loads that none of the ``keep`` newest versions names from the catalog
        and the file system, also those that a failed write left. Returns their names.

        Loads written in the last ``older_than`` seconds stay: another writer may be about
        to commit them, or a query may still read them.
        """
        versions = self.versions(layer)
        self.follow_version(layer)
        loads, numbers = versions.garbage(max(keep, 1), older_than, folder_of)
        if layer in self._open:
            writing = {folder_of(load) for load in self._open[layer].loads.values()}
            loads = [load for load in loads if load not in writing]
        for stored in self.spark.catalog.listTables(self.database(layer)) if loads else ():
            if stored.tableType != "VIEW" and folder_of(stored.name) in loads:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, stored.name)}")
        versions.remove(loads, numbers)
        return loads
