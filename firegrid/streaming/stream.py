"""Near-real-time path: the batch operators on a stream of detection files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from firegrid.functions.dates import local_solar_ts
from firegrid.functions.geo import modis_tile
from firegrid.functions.text import normalize_hhmm
from firegrid.operators.prep import prepare
from firegrid.session import cut
from firegrid.sources.detections import DETECTION_SCHEMA, conform, with_instrument
from firegrid.sources.sinks import overwrite_days

KEYS = ["latitude", "longitude", "acq_date", "acq_time", "satellite"]


def stream_detections(spark: SparkSession, folder: str, columns: list[str] | None = None, files_per_trigger: int = 100) -> DataFrame:
    """Detections arriving as CSV files with a header.

    CSV columns are matched by position, so ``columns`` names them in file order; by default they are
    taken from the header of the files already there.  A file with another header is an error.
    """
    names = columns or spark.read.option("header", True).csv(folder).columns
    kinds = {f.name: f.dataType for f in DETECTION_SCHEMA}
    schema = T.StructType([T.StructField(n, kinds.get(n.lower(), T.StringType())) for n in names])
    raw = (
        spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_trigger).csv(folder).withColumn("_path", F.col("_metadata.file_path"))
    )
    return with_instrument(conform(raw)).drop("_path")


def with_event_time(df: DataFrame, delay: str = "2 days") -> DataFrame:
    """Event time of a detection (UTC) with a watermark."""
    ts = local_solar_ts(F.col("acq_date"), normalize_hhmm(F.col("acq_time")), F.lit(0.0))
    return df.withColumn("acq_ts", ts).withWatermark("acq_ts", delay)


def drop_redelivered(df: DataFrame) -> DataFrame:
    """Rows delivered again within the watermark are taken once."""
    return df.dropDuplicatesWithinWatermark(KEYS)


def stream_prep(df: DataFrame, date_definition: str = "UTC") -> DataFrame:
    """The batch cleaning, unchanged: it is row-local.

    ``rawid`` is a hash of the natural key.  Ids need to differ within a day; ``upsert_days`` stops
    with an error should two detections of a day ever share one.
    """
    keyed = df.withColumn("rawid", F.xxhash64(*KEYS).bitwiseAND(F.lit((1 << 61) - 1)))
    return prepare(keyed, date_definition)


def daily_tile_counts(df: DataFrame) -> DataFrame:
    """Detections and radiative power per day and tile (tumbling one-day windows)."""
    return (
        df.groupBy(F.window("acq_ts", "1 day"), modis_tile(F.col("longitude"), F.col("latitude")).alias("tile"))
        .agg(F.count("*").alias("n"), F.sum("frp").alias("frp"))
        .select(F.col("window.start").cast("date").alias("day"), "tile", "n", "frp")
    )


def upsert_days(path: str):
    """A ``foreachBatch`` writer: rows of a batch join the stored rows of their days, others stay untouched.

    Writing the same batch again gives the same days (a row replaces the stored row of the same id,
    place and time), so a restarted batch does no harm.
    """
    same = ["acq_date_use", "cleanid", "lon", "lat", "acq_time_utc"]

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        days = [r.acq_date_use for r in batch.select("acq_date_use").distinct().collect()]
        if days:
            merged = batch
            if _exists(spark, path):
                stored = spark.read.schema(batch.schema).parquet(path).where(F.col("acq_date_use").isin(days))
                merged = cut(stored.join(batch, same, "left_anti").unionByName(batch))
            shared = merged.groupBy("acq_date_use", "cleanid").agg(F.count("*").alias("n")).where("n > 1")
            if not shared.isEmpty():
                raise ValueError(f"two detections of a day share an id: {shared.first()}")
            overwrite_days(merged, path)
        batch.unpersist()

    return write


def _exists(spark: SparkSession, path: str) -> bool:
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name)


def run_available_now(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived, then stop."""
    return (
        df.writeStream.foreachBatch(upsert_days(path)).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def run_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Hand over every window that changed, one folder per batch, and stop when nothing more has arrived.

    Update mode: a window leaves the state once the watermark has passed it, so the state holds only
    the days within the delay.  A batch that runs again replaces its own folder.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (
        windows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def newest(states: DataFrame, keys: list[str]) -> DataFrame:
    """The last state of every window from the folders of ``run_windows``."""
    values = [c for c in states.columns if c not in (*keys, "epoch")]
    return states.groupBy(*keys).agg(F.max_by(F.struct(*values), "epoch").alias("_s")).select(*keys, "_s.*")
