"""Search documents on disk: bulk text, and keyed merges of document collections."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions.names import encoded_column_name
from locusmill.vocabulary import WRITE_MODES


def check_mode(mode: str) -> str:
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode: {mode}")
    return mode


def encode_columns(rows: DataFrame, dot: str | None = "_") -> DataFrame:
    """Rename the top-level columns to names that a document can hold."""
    return rows.select(*[F.col(f"`{c}`").alias(encoded_column_name(c, dot)) for c in rows.columns])


def document_json(rows: DataFrame, mode: str = "index") -> Column:
    """One JSON object per row. Nulls are left out, but update and upsert write them."""
    keep_nulls = check_mode(mode) in ("update", "upsert")
    return F.to_json(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]),
        {"ignoreNullFields": "false" if keep_nulls else "true"},
    )


def bulk_documents(
    rows: DataFrame, collection: str, id_column: str | None = None, mode: str = "index", dot: str | None = "_"
) -> DataFrame:
    """``id, action, body`` of every document: the two lines of a bulk request."""
    encoded = encode_columns(rows, dot)
    doc_id = F.lit(None).cast("string") if id_column is None else F.col(
        f"`{encoded_column_name(id_column, dot)}`"
    ).cast("string")
    verb = "update" if check_mode(mode) == "upsert" else mode
    target = F.to_json(
        F.struct(F.lit(collection).alias("_index"), doc_id.alias("_id")), {"ignoreNullFields": "true"}
    )
    body = document_json(encoded, mode)
    if mode == "update":
        body = F.concat(F.lit('{"doc":'), body, F.lit("}"))
    elif mode == "upsert":
        body = F.concat(F.lit('{"doc":'), body, F.lit(',"doc_as_upsert":true}'))
    return encoded.select(
        doc_id.alias("id"), F.concat(F.lit(f'{{"{verb}":'), target, F.lit("}")).alias("action"), body.alias("body")
    )


def write_bulk(
    rows: DataFrame,
    path: str,
    collection: str,
    id_column: str | None = None,
    mode: str = "index",
    block_size: int = 5000,
    num_shards: int = 10,
    replace: bool = True,
    dot: str | None = "_",
    file_records: int = 500_000,
) -> None:
    """Write bulk text: requests of ``block_size`` documents at most, an empty line between them.

    The shard is a folder that rows are routed to by hash, not a task: writing stays as parallel
    as the input even with one shard. ``file_records`` bounds the documents of a file, so files
    have a size of their own, however small the requests. A new file starts a new request.
    """
    documents = bulk_documents(rows, collection, id_column, mode, dot)
    shard = F.pmod(F.xxhash64(F.coalesce("id", "body")), F.lit(num_shards)).cast("int").alias("shard")
    lines = documents.select(shard, F.concat_ws("\n", "action", "body").alias("value"))
    (
        lines.mapInArrow(request_blocks(block_size, file_records), "shard int, value string")
        .write.mode("overwrite" if replace else "append")
        .option("maxRecordsPerFile", file_records)
        .partitionBy("shard")
        .text(path)
    )


def request_blocks(block_size: int, file_records: int):
    """A function for mapInArrow over ``shard, value`` rows: an empty line goes before the first
    document of each request but the first of a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written: dict[int, int] = {}
        for part in batches:
            shards, first = part.column("shard").to_numpy(), np.zeros(len(part), bool)
            for shard in np.unique(shards).tolist():
                own = np.flatnonzero(shards == shard)
                place = (written.get(shard, 0) + np.arange(len(own))) % file_records
                first[own] = (place % block_size == 0) & (place > 0)
                written[shard] = written.get(shard, 0) + len(own)
            marks = pc.if_else(pa.array(first), "\n", "")
            values = pc.binary_join_element_wise(marks, part.column("value"), "")
            yield pa.RecordBatch.from_arrays([part.column("shard"), values], names=["shard", "value"])

    return run


def unite_collections(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Several sources in one collection; a missing column is NULL."""
    united = first
    for other in others:
        united = united.unionByName(other, allowMissingColumns=True)
    return united


def _incoming_once(incoming: DataFrame, id_column: str, mode: str, order_by: list[str] | None) -> DataFrame:
    """One incoming document per id: the first for create, the last for the other modes.

    Without an order the choice is by content. The extreme is kept map-side, so an id that is
    repeated very often sends one row per task.
    """
    order = F.struct(*(order_by or [c for c in incoming.columns if c != id_column]))
    pick = F.min_by if mode == "create" else F.max_by
    others = [c for c in incoming.columns if c != id_column]
    chosen = incoming.groupBy(id_column).agg(pick(F.struct(*others), order).alias("_doc"))
    return chosen.select(id_column, *[F.col(f"_doc.`{c}`").alias(c) for c in others])


def merge_documents(
    existing: DataFrame,
    incoming: DataFrame,
    id_column: str,
    mode: str = "index",
    order_by: list[str] | None = None,
) -> DataFrame:
    """The collection after the incoming documents were written.

    index: the incoming document replaces all of the old one. create: only new ids are added.
    update: fields of known ids are replaced, nulls included. upsert: update or add.
    ``existing`` has one row per id.
    """
    check_mode(mode)
    new = _incoming_once(incoming, id_column, mode, order_by)
    if mode == "create":
        return unite_collections(existing, new.join(existing.select(id_column), id_column, "left_anti"))
    old = existing.withColumn("_old", F.lit(True)).alias("old")
    fresh = new.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(fresh, F.col(f"old.{id_column}") == F.col(f"new.{id_column}"),
                      "left" if mode == "update" else "full")
    written = F.coalesce(F.col("_new"), F.lit(False))

    def field(name: str) -> Column:
        was = F.col(f"old.`{name}`") if name in existing.columns else F.lit(None)
        if name in incoming.columns:
            return F.when(written, F.col(f"new.`{name}`")).otherwise(was)
        return F.when(~written, was) if mode == "index" else was

    names = existing.columns + [c for c in incoming.columns if c not in existing.columns]
    return joined.select(
        *[
            (F.coalesce(f"old.{c}", f"new.{c}") if c == id_column else field(c)).alias(c)
            for c in names
        ]
    )


def merge_rejects(existing: DataFrame, incoming: DataFrame, id_column: str, mode: str) -> DataFrame:
    """``id, reason, n``: documents that create finds existing, or update finds missing."""
    check_mode(mode)
    counted = incoming.groupBy(F.col(id_column).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    known = existing.select(F.col(id_column).alias("id"), F.lit(True).alias("known"))
    looked_up = counted.join(known, "id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    if mode == "create":
        # of several new documents with one id only the first is created
        refused = F.when(F.col("known"), F.col("n")).otherwise(F.col("n") - 1)
        return looked_up.select("id", F.lit("exists").alias("reason"), refused.alias("n")).where("n > 0")
    missing = ~F.col("known") if mode == "update" else F.lit(False)
    return looked_up.where(missing).select("id", F.lit("missing").alias("reason"), "n")


def write_merged(
    existing: DataFrame,
    incoming: DataFrame,
    path: str,
    id_column: str,
    mode: str = "index",
    ignore_errors: bool = False,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Write the merged collection into a new folder below ``path`` and return the rejects.

    Without ``ignore_errors`` rejects stop it. ``existing`` may be what an earlier merge wrote:
    nothing is overwritten, and :func:`read_merged` reads the newest version. Rejects are written
    beside the collection, so they are found once.
    """
    version = f"{path}/version-{time.time_ns():020d}"
    rejects = merge_rejects(existing, incoming, id_column, mode)
    write_table(rejects, f"{version}-rejects")
    rejects = existing.sparkSession.read.schema(rejects.schema).parquet(f"{version}-rejects")
    if not ignore_errors and not rejects.isEmpty():
        raise ValueError(f"{mode} refused documents of {path}; see {version}-rejects")
    write_table(merge_documents(existing, incoming, id_column, mode, order_by), version)
    return rejects


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a collection that was written whole."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version-*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done) or []
    versions = [str(f.getPath().getParent()) for f in found]
    whole = [v for v in versions if not v.endswith("-rejects")]
    if not whole:
        raise ValueError(f"no collection at {path}")
    return spark.read.parquet(max(whole))


def write_table(rows: DataFrame, path: str, replace: bool = True) -> None:
    rows.write.mode("overwrite" if replace else "append").parquet(path)


#: Buckets of a collection, unless it says otherwise when it is made.
BUCKETS = 64


def _bucket(id_column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(buckets)).cast("int")


def _newest(spark: SparkSession, path: str) -> dict[int, str | None] | None:
    """Folder of each bucket in the newest version that was written whole; None without any."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done) or []
    versions = [str(f.getPath().getParent()) for f in found]
    return {r.bucket: r.folder for r in spark.read.parquet(max(versions)).collect()} if versions else None


def _write_version(spark: SparkSession, path: str, folders: dict[int, str | None]) -> None:
    """A version is a small table of buckets and folders; readers see it once it is whole."""
    rows = spark.createDataFrame(sorted(folders.items()), "bucket int, folder string").coalesce(1)
    rows.write.parquet(f"{path}/versions/{time.time_ns():020d}")


def _write_buckets(rows: DataFrame, path: str, id_column: str, buckets: int, touched: list[int]) -> dict[int, str | None]:
    """Write the rows to a new folder, a file for each bucket, and name the folder of each touched bucket."""
    folder = f"{path}/data/{uuid.uuid4().hex}"
    dealt = rows.withColumn("_bucket", _bucket(id_column, buckets)).repartitionById(buckets, "_bucket")
    dealt.write.partitionBy("_bucket").parquet(folder)
    spark = rows.sparkSession
    # a bucket that lost its last row has no folder; the driver gets at most one row for each bucket
    filled = {r[0] for r in spark.read.parquet(folder).select("_bucket").distinct().collect()} if touched else set()
    return {b: f"{folder}/_bucket={b}" if b in filled else None for b in touched}


def write_collection(rows: DataFrame, path: str, id_column: str, buckets: int = BUCKETS) -> None:
    """Start a collection of documents by id below ``path``, dealt to buckets by a hash of the id."""
    _write_version(rows.sparkSession, path, _write_buckets(rows, path, id_column, buckets, list(range(buckets))))


def merge_collection(
    incoming: DataFrame, path: str, id_column: str, mode: str = "index", ignore_errors: bool = False, order_by: list[str] | None = None
) -> DataFrame:
    """Merge documents into a collection and return the rejects; see :func:`merge_documents`.

    Only buckets that incoming ids fall into are read and written anew; the files of the others
    stay as they are. Nothing is overwritten: readers see the old version until the new one is
    whole, and a merge that fails leaves no version. Without ``ignore_errors`` rejects stop it.
    """
    spark = incoming.sparkSession
    folders = _newest(spark, path)
    if folders is None:
        raise ValueError(f"no collection at {path}")
    buckets = len(folders)
    touched = sorted(r[0] for r in incoming.select(_bucket(id_column, buckets)).distinct().collect())
    read = [folders[b] for b in touched if folders[b]]
    some = next((f for f in folders.values() if f), None)
    if some is None:
        raise ValueError(f"the collection at {path} is empty")
    existing = spark.read.option("mergeSchema", "true").parquet(*read) if read else spark.read.parquet(some).limit(0)
    rejects = merge_rejects(existing, incoming, id_column, mode)
    folder = f"{path}/rejects/{uuid.uuid4().hex}"
    write_table(rejects, folder)
    rejects = spark.read.schema(rejects.schema).parquet(folder)
    if not ignore_errors and not rejects.isEmpty():
        raise ValueError(f"{mode} refused documents of {path}; see {folder}")
    merged = merge_documents(existing, incoming, id_column, mode, order_by)
    _write_version(spark, path, folders | _write_buckets(merged, path, id_column, buckets, touched))
    return rejects


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a collection that was written whole. Columns that came later are NULL elsewhere."""
    folders = [f for f in (_newest(spark, path) or {}).values() if f]
    if not folders:
        raise ValueError(f"no documents at {path}")
    return spark.read.option("mergeSchema", "true").parquet(*folders)
