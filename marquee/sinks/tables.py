"""Writers. Every one can be repeated after a failure: it replaces what it wrote before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import merge
from marquee.operators.stats import column_fill
from marquee.operators.validate import prune
from marquee.schema import ENTITY_COLUMNS, GOLD_FIXED, GOLD_REFRESHED, PROPERTIES
from marquee.sinks.history import STATE, UrlHistory
from marquee.sinks.versions import Version, VersionedTable, bucket
from marquee.sources.pages import with_bronze_columns

BRONZE_BUCKETS = 200

GOLD = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("entity_type", "dedup_key", *GOLD_FIXED)]
    + [
        T.StructField(name, T.DoubleType() if name == "price_value" else T.StringType())
        for name in GOLD_REFRESHED
    ]
)


def run_date(run_id: Column) -> Column:
    """The day a run id ends in: its last dash-separated part starts with yyyymmdd."""
    stamp = F.left(F.element_at(F.split(run_id, "-"), -1), F.lit(8))
    return F.to_date(F.try_to_timestamp(stamp, F.lit("yyyyMMdd")))


def run_date_text(spark: SparkSession, run_id: str) -> str:
    day = spark.range(1).select(run_date(F.lit(run_id)).cast("string")).first()[0]
    if day is None:
        raise ValueError(f"run id {run_id!r} does not end in a date")
    return day


def write_bronze(pages: DataFrame, path: str) -> None:
    """Append snapshots; one folder per fetch day, url_hash and snapshot name as columns."""
    with_bronze_columns(pages).write.mode("append").partitionBy("fetch_date").parquet(path)


def write_bronze_table(pages: DataFrame, name: str, path: str, buckets: int = BRONZE_BUCKETS) -> None:
    """Append snapshots to a table in buckets sorted by url, a folder per fetch day.

    Pages joined by url are then read bucket by bucket: only the other side of the join moves. With
    fewer buckets than shuffle partitions Spark may move both sides after all.
    """
    (
        with_bronze_columns(pages)
        .write.mode("append")
        .partitionBy("fetch_date")
        .bucketBy(buckets, "url")
        .sortBy("url")
        .option("path", path)
        .saveAsTable(name)
    )


def write_silver(entities: DataFrame, path: str, run_id: str) -> None:
    """JSON lines per entity type and run; null fields are left out of a line."""
    columns = [name for name in ENTITY_COLUMNS if name in entities.columns]
    (
        entities.select("entity_type", F.lit(run_id).alias("run_id"), *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("entity_type", "run_id")
        .json(path)
    )


def csv_rows(entities: DataFrame, entity_type: str, filled: list[str]) -> DataFrame:
    """The rows of one type with the named columns, nested ones as JSON."""
    rows = prune(entities.filter(F.col("entity_type") == entity_type), entity_type)
    nested = (T.ArrayType, T.StructType, T.MapType)
    kinds = {field.name: field.dataType for field in rows.schema.fields}
    return rows.select(
        *[F.to_json(n).alias(n) if isinstance(kinds[n], nested) else F.col(n) for n in filled]
    )


def write_csv(entities: DataFrame, path: str, run_id: str) -> list[str]:
    """One CSV per run day and type; a later run of the day replaces the file of its types.

    The header holds the columns that any row of the type fills, sorted. Types without rows write
    nothing. Returns the folders written.
    """
    day = run_date_text(entities.sparkSession, run_id)
    columns = [name for name in ENTITY_COLUMNS if name in entities.columns]
    header: dict[str, list[str]] = {}
    for row in column_fill(entities.select("entity_type", *columns)).collect():
        header.setdefault(row["entity_type"], []).append(row["column"])
    written = []
    for entity_type, filled in sorted(header.items()):
        folder = f"{path.rstrip('/')}/{day}/{entity_type}"
        allowed = [name for name in sorted(filled) if name in dict(PROPERTIES[entity_type])]
        rows = csv_rows(entities, entity_type, allowed)
        rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)
        written.append(folder)
    return written


def write_rejects(rejects: DataFrame, path: str, run_id: str) -> None:
    """Quarantine: rejected entities as they were before pruning, with their reasons."""
    (
        rejects.select("entity", "reason", F.lit(run_id).alias("run_id"))
        .withColumn("rejected_at", F.current_timestamp())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .json(path)
    )


def write_row(row: DataFrame, path: str) -> None:
    """One-row tables: a run manifest or the metrics of a run."""
    row.write.mode("overwrite").json(path)


def write_url_state(state: DataFrame, path: str, batch: str) -> None:
    """Add observations of URLs under a batch name; the last one of a URL is its state."""
    columns = [
        F.col(f.name) if f.name in state.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in STATE.fields
    ]
    UrlHistory(state.sparkSession, path).remember(state.select(*columns), batch)


def write_source_counts(counts: DataFrame, path: str, run_id: str) -> None:
    """rows_new, rows_updated and rejects of every source of a run; a repeated run replaces its own."""
    (
        counts.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


class GoldTable:
    """The keyed gold table in hash buckets of each type, every version a list of folders.

    A batch is joined with the buckets it touches and only these are written anew. The log (see
    `versions`) lets a batch in once, keeps a failed one out, and makes one of two writers at a time
    start over from what the other one wrote.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16) -> None:
        self.spark, self.root = spark, root.rstrip("/")

        def place() -> Column:
            kind = F.regexp_replace("entity_type", r"\W", "_")
            return F.concat(kind, bucket(["entity_type", "dedup_key"], buckets, "-"))

        self.table = VersionedTable(spark, self.root, GOLD, place)

    def read(self) -> DataFrame:
        return self.table.read()

    def upsert(self, batch: DataFrame, name: str) -> None:
        """Apply gold rows with at most one row per key under a batch name."""
        staged: dict[str, str] = {}

        def change(base: Version) -> dict[str, list[str]]:
            if not staged:  # written once, also when another writer comes first
                staged.update(self.table.write(batch, base))
            if not staged:
                return base.places
            new = self.table.rows(Version(base.number, {p: [f] for p, f in staged.items()}))
            current = self.table.rows(base, staged)
            merged = self.table.write(merge.upsert(current, new), base)
            return {**base.places, **{place: [folder] for place, folder in merged.items()}}

        self.table.update(name, change)
