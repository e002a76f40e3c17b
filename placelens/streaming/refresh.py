"""Daily refresh: a country that is delivered again replaces what was there, and readers never see half of it.

A delivery is a raw dump file; its key is the file name up to the first dot (``DE`` for ``2024-05-01/DE.csv.gz``). The store holds

* ``places/version=N/delivery=K``: the cleaned places of a delivery, written once and never changed,
* ``counts/version=N/delivery=K``: their counts per country and code,
* ``manifest/version=N``: which version of every delivery counts, a row for each, with the file it came from,
* ``CURRENT``: the number of the manifest that readers use, replaced by one atomic rename.

A refresh writes new folders and a new manifest and then moves the pointer. A crash before that leaves the old version as
it was, and the repeated refresh writes the same folders again. Only the deliveries at hand are read and written, however
large the store is. Of several files of a delivery the one modified last counts (then the greater path), also against the
one in the store; so a batch that is repeated, or an old file that arrives late, changes nothing. A file without
rows says nothing. What no manifest needs any more goes with :func:`vacuum`.

Files come as a stream (:func:`run_refresh`), which knows a file by its path, or by a look at the folder
(:func:`refresh_changed`), which also takes a file that was replaced under its old path. One refresh of a store
runs at a time. Manifests have a row for each delivery, a catalogue of countries, and are the only thing the driver reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placelens import schemas
from placelens.operators.cleaning import clean_places
from placelens.session import shared_folder

MANIFEST = "delivery STRING, version BIGINT, file STRING, modified TIMESTAMP"
FILE = ["_delivery", "_file", "_modified"]


def _delivery() -> Column:
    """The key of a row's file; metadata has file names as they stand in a URI, where a plus is a plus."""
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return F.substring_index(name, ".", 1)


def _raw_places(reader, folder: str | list[str]) -> DataFrame:
    raw = reader.schema(schemas.RAW_PLACES).option("sep", "\t").option("quote", "").csv(folder)
    told = _delivery(), F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    return raw.select("*", *[c.alias(n) for c, n in zip(told, FILE)])


def stream_raw_places(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New raw dump files under a folder (or glob), as a stream, each row with the file it comes from."""
    return _raw_places(spark.readStream.option("maxFilesPerTrigger", files_per_batch), folder)


# The store.


def _paths(spark: SparkSession, store: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(store)
    return jvm, root.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, store: str) -> int:
    """The number of the manifest that counts; 0 for a store without one."""
    jvm, files = _paths(spark, store)
    pointer = jvm.Path(f"{store}/CURRENT")
    if not files.exists(pointer):
        return 0
    return int(spark.read.text(pointer.toString()).first().value)


def _switch(spark: SparkSession, store: str, version: int) -> None:
    """Point readers to a manifest: a small file is written beside the pointer and renamed over it."""
    jvm, files = _paths(spark, store)
    new, pointer = (files.makeQualified(jvm.Path(f"{store}/{name}")) for name in (f"_next-{version}", "CURRENT"))
    out = files.create(new, True)
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    context = jvm.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    overwrite = spark._jvm.java.lang.reflect.Array.newInstance(options, 1)
    overwrite[0] = next(x for x in options.getEnumConstants() if x.toString() == "OVERWRITE")
    context.rename(new, pointer, overwrite)


def manifest(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """A row for each delivery: which version of it counts, and the file it came from."""
    version = current_version(spark, store) if version is None else version
    if not version:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{store}/manifest/version={version}")


def _live(spark: SparkSession, store: str, table: str, schema: str, deliveries: list[str] | None) -> DataFrame:
    rows = manifest(spark, store)
    if deliveries is not None:
        rows = rows.where(F.col("delivery").isin(deliveries))
    folders = [f"{store}/{table}/version={r.version}/delivery={_escaped(spark, r.delivery)}" for r in rows.collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def _escaped(spark: SparkSession, value: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def read_places(spark: SparkSession, store: str, deliveries: list[str] | None = None) -> DataFrame:
    """The cleaned places of the newest deliveries (or some of them); a reader keeps the version it began with."""
    return _live(spark, store, "places", schemas.CLEAN_PLACES, deliveries)


def read_counts(spark: SparkSession, store: str) -> DataFrame:
    """Counts per country and code over the newest deliveries, from the counts of each."""
    counts = _live(spark, store, "counts", "country_code STRING, feature_code STRING, n BIGINT", None)
    return counts.groupBy("country_code", "feature_code").agg(F.sum("n").alias("n"))


def vacuum(spark: SparkSession, store: str, keep: int = 2) -> int:
    """Delete versions of deliveries that none of the last ``keep`` manifests names; returns how many folders went."""
    jvm, files = _paths(spark, store)
    now = current_version(spark, store)
    wanted, gone = set(), 0
    listed = lambda path: [x.getPath() for x in files.listStatus(jvm.Path(path))] if files.exists(jvm.Path(path)) else []
    for folder in listed(f"{store}/manifest"):
        version = int(folder.getName().removeprefix("version="))
        if now - keep < version <= now:
            kept = manifest(spark, store, version).select("version", "delivery").collect()
            wanted |= {(f"version={r.version}", f"delivery={_escaped(spark, r.delivery)}") for r in kept}
        else:
            gone += files.delete(folder, True)
    for table in ("places", "counts"):
        for folder in listed(f"{store}/{table}"):
            for part in listed(folder.toString()):
                if part.getName().startswith("delivery=") and (folder.getName(), part.getName()) not in wanted:
                    gone += files.delete(part, True)
    return gone


# Refreshing.


def apply_deliveries(raw: DataFrame, store: str) -> int:
    """Put the newest file of each delivery in ``raw`` (with the columns of a file) in its place; the version that counts then."""
    spark = raw.sparkSession
    before = current_version(spark, store)
    known = manifest(spark, store, before)
    delivery, file, modified = FILE
    newest = (
        raw.groupBy(F.col(delivery).alias("delivery"))
        .agg(F.max(F.struct(F.col(modified).alias("modified"), F.col(file).alias("file"))).alias("new"))
        .select("delivery", "new.file", "new.modified")
    )
    old = known.select("delivery", F.struct("modified", "file").alias("old"))
    newer = newest.join(old, "delivery", "left").where("old is null or struct(modified, file) > old").drop("old").collect()
    if not newer:
        return before
    version = before + 1
    added = spark.createDataFrame([(r.delivery, version, r.file, r.modified) for r in newer], MANIFEST)
    # A row for each delivery of this refresh, a catalogue; the files' other rows stay out.
    wanted = F.broadcast(added.select(F.col("file").alias(file)))
    cleaned = clean_places(raw.join(wanted, file, "left_semi").drop(file, modified))
    places = f"{store}/places/version={version}"
    cleaned.withColumnRenamed(delivery, "delivery").hint("rebalance", "delivery").write.mode("overwrite").partitionBy("delivery").parquet(places)
    written = spark.read.schema(f"{schemas.CLEAN_PLACES}, delivery STRING").parquet(places)
    counts = written.groupBy("delivery", "country_code", "feature_code").agg(F.count("*").alias("n"))
    counts.hint("rebalance", "delivery").write.mode("overwrite").partitionBy("delivery").parquet(f"{store}/counts/version={version}")
    rest = known.join(F.broadcast(added.select("delivery")), "delivery", "left_anti").select(added.columns)
    rest.unionByName(added).coalesce(1).write.mode("overwrite").parquet(f"{store}/manifest/version={version}")
    _switch(spark, store, version)
    return version


def run_refresh(raw: DataFrame, store: str, checkpoint: str | None = None, name: str = "place_refresh") -> StreamingQuery:
    """Take the files that are new in the stream, put them in the store and stop.

    The checkpoint defaults to the cluster's shared folder.
    """
    location = checkpoint or shared_folder(raw.sparkSession, name)
    return (
        raw.writeStream.queryName(name)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .foreachBatch(lambda rows, _batch: apply_deliveries(rows, store) and None)
        .start()
    )


def refresh_changed(spark: SparkSession, folder: str, store: str) -> int:
    """Take files under ``folder`` that are new, or newer than the store's, also under an old path; the version that counts then."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    # Contents aren't read: only names and times are selected.
    told = F.struct(F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_path").alias("file"))
    files = listed.select("path", told.alias("new"), _delivery().alias("delivery"))
    known = manifest(spark, store).select("delivery", F.struct("modified", "file").alias("old"))
    newest = files.groupBy("delivery").agg(F.max("new").alias("new"), F.max_by("path", "new").alias("path"))
    newer = newest.join(known, "delivery", "left").where("old is null or new > old").select("path").collect()
    if not newer:
        return current_version(spark, store)
    return apply_deliveries(_raw_places(spark.read, [r.path for r in newer]), store)
