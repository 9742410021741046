"""Token ids in raw files, found by document key through minimal perfect hashes.

A store is a folder with

- ``payload/*.ids``: nothing but ids, little endian, 2 bytes each if the vocabulary allows it,
  else 4; documents in ascending order of doc_id, file after file, an end id after each;
- ``entries``: a row per document with its shard (the file's number), its file, the place of
  its first id in that file and how many it has;
- ``shards``: a row per file with the number of ids in all files before it;
- ``index``: buckets of keys by hash, each with a minimal perfect hash, fingerprints, and by
  slot the shard, place and count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import attempt_name, filesystem, load, make_folder, narrow, ship_package, slices
from marquee.llm.perfect_hash import PerfectHash
from marquee.llm.pieces import encoder
from marquee.session import scratch_path

END_ID = 0
BUCKET_KEYS = 4_096
ENTRIES = "doc_id long, shard int, file string, place long, n_tokens long"


def bucket_of(count: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int").alias("bucket")


def write_store(documents: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode whole texts and write a store.

    Texts are dealt out in ranges of doc_id, then of text, so rows that repeat a doc_id, or
    have none, may fill several files; null doc_ids come first. A null or empty text has the
    end id only. Each file is written under a name of its task attempt's own and counts only
    if ``entries`` names it, so tasks may be repeated. The index has one place per doc_id, the
    first; rows beyond it, and those without doc_id, are found through ``entries``.
    """
    spark = documents.sparkSession
    ship_package(spark)
    folder = f"{path}/payload"
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, place = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], encode.dtype).tobytes()
        fs, target = filesystem(f"{folder}/{attempt_name('shard')}.ids")
        out = None
        for batch in batches:
            for part in slices(batch, "text"):
                out = out or fs.open_output_stream(target, compression=None)
                ids = encode.encode([t or "" for t in part.column("text").to_pylist()])
                counts = np.array([len(x) // encode.dtype.itemsize + 1 for x in ids], np.int64)
                out.write(end.join(ids) + end)
                ends = place + np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(np.full(len(ids), shard, np.int32)),
                     pa.array([target] * len(ids)), pa.array(ends - counts), pa.array(counts)],
                    ["doc_id", "shard", "file", "place", "n_tokens"])
                place = int(ends[-1])
        if out:
            out.close()

    order = [F.col("doc_id").cast("long").asc_nulls_first(), F.xxhash64("text")]
    source = narrow(documents, "doc_id", "text")
    # as many files as there are parts of the input, so a file does not grow with the whole of it
    files = max(source.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    (source.repartitionByRange(files, *order).sortWithinPartitions(*order)
     .mapInArrow(write, ENTRIES).write.parquet(f"{path}/entries"))

    entries = spark.read.schema(ENTRIES).parquet(f"{path}/entries")
    by_shard = entries.groupBy("shard", "file").agg(F.sum("n_tokens").alias("ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    by_shard.select("shard", "file", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before")) \
        .write.parquet(f"{path}/shards")

    first = entries.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct("shard", "place", "n_tokens")).alias("at"))
    buckets = max(1, -(-first.count() // BUCKET_KEYS))

    def build(table: pa.Table) -> pa.Table:
        keys = table.column("doc_id").to_numpy()
        hashed = PerfectHash.build(keys)
        slots, by_slot = hashed.find(keys), {}
        for name in ("shard", "place", "n_tokens"):
            values = table.column(name).to_numpy()
            by_slot[name] = np.zeros_like(values)
            by_slot[name][slots] = values
        return pa.table({"bucket": table.column("bucket")[:1],
                         "hashed": pa.array([hashed.pack(**by_slot)], pa.binary())})

    (first.select("doc_id", "at.*", bucket_of(buckets)).groupBy("bucket")
     .applyInArrow(build, "bucket int, hashed binary")
     .withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/index"))


def locate(keys: DataFrame, path: str) -> DataFrame:
    """Where the ids of each ``doc_id`` begin: its shard, place and count, from the index.

    Keys that the store does not have, and null ones, are left out. Repeated keys give one row.
    """
    spark = keys.sparkSession
    index = spark.read.schema("bucket int, hashed binary, buckets int").parquet(f"{path}/index")
    known = index.select("buckets").first()
    wanted = narrow(keys, "doc_id").select(F.col("doc_id").cast("long")).filter("doc_id is not null").distinct()

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["shard", "place", "n_tokens"]
        if not left.num_rows or not right.num_rows:
            empty = {"doc_id": pa.int64(), "shard": pa.int32(), "place": pa.int64(), "n_tokens": pa.int64()}
            return pa.table({k: pa.array([], t) for k, t in empty.items()})
        hashed, by_slot = PerfectHash.unpack(right.column("hashed")[0].as_py())
        doc_ids = left.column("doc_id").to_numpy()
        slots = hashed.find(doc_ids)
        known = slots >= 0
        return pa.table({"doc_id": doc_ids[known], **{n: by_slot[n][slots[known]] for n in names}})

    return (wanted.select("doc_id", bucket_of(known.buckets if known else 1)).groupBy("bucket")
            .cogroup(index.groupBy("bucket"))
            .applyInArrow(find, "doc_id long, shard int, place long, n_tokens long"))


def read_ids(places: DataFrame, path: str, dtype: str, work, schema: str) -> DataFrame:
    """Read the ids at ``places`` and give, for each document, what ``work`` makes of them.

    Places are dealt out by file, and read one after the other by offset.
    """
    shards = places.sparkSession.read.schema("shard int, file string, before long").parquet(f"{path}/shards")
    size = np.dtype(dtype).itemsize

    def read(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        fs, target = filesystem(table.column("file")[0].as_py())
        rows = []
        with fs.open_input_file(target) as held:
            for place, count in zip(table.column("place").to_pylist(), table.column("n_tokens").to_pylist()):
                rows.append(work(np.frombuffer(held.read_at(count * size, place * size), dtype)))
        starts = table.column("place").to_numpy() + table.column("before").to_numpy()
        columns = {"doc_id": table.column("doc_id"), "start": starts, "n_tokens": table.column("n_tokens")}
        return pa.table(columns | {k: [r[k] for r in rows] for k in rows[0]})

    # a task per file: the work is in the files, not in these short rows
    return (places.select("doc_id", "shard", "place", "n_tokens").join(shards, "shard")
            .repartition(max(1, shards.count()), "shard").groupBy("shard").applyInArrow(read, "doc_id long, start long, n_tokens long, " + schema))


def checksum(ids: np.ndarray) -> dict[str, int]:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents, then read them back, by key where they have a key of their own."""
    documents = load(spark, sf_dir, "documents")
    path = scratch_path(spark, "tokens")
    write_store(documents, path)
    by_key = locate(documents, path)
    entries = spark.read.schema(ENTRIES).parquet(f"{path}/entries")
    others = entries.join(by_key.select("shard", "place"), ["shard", "place"], "left_anti")
    places = by_key.unionByName(others.select(by_key.columns))
    return read_ids(places, path, encoder().dtype.str, checksum, "ids_crc32 long")
