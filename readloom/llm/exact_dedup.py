"""Exact de-duplication through an extendible-hash index on shared files.

1. Every text is normalised (each run of ASCII spaces becomes one space) and
   hashed.  The keys ``(doc_id, hash, sha256)`` go to a shared table.
2. A directory over the leading hash bits is grown by doubling: a bucket that
   holds more keys than ``capacity`` splits, until none is overfull.  The
   capacity follows from the rows and the tasks (``SHARE`` buckets for each),
   so the directory is bounded by the number of tasks, not by the data.
3. Neighbouring buckets, a range of keys, belong to one owner task.  Equal texts
   are combined inside each map task, so a hot text leaves a task once, and the
   survivors go to their owner.  It walks its keys in hash order, chains keys of
   equal hash, and compares bytes.
4. Directory and buckets are files in the shared folder: ``directory`` (cell of
   leading bits, bucket, owner) and ``buckets`` (the chains, by owner).
5. Every document finds its chain entry by an equi-join.  The groups of more
   rows than a task's share are fewer than the tasks, so they are joined by
   broadcast and none is shuffled to one task.

Results: null and empty texts are equal.  Of equal texts the smallest
``doc_id`` stays; a null ``doc_id`` is larger than any other.  Rows repeated with
one and the same smallest ``doc_id`` all stay, so do all rows of a group that
has no id.  An empty table gives an empty one.  Texts of any length are taken
whole.  Further columns are ignored, whatever their names.  Two different texts
under one SHA-256 raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.bytesops import single_spaced, slices
from readloom.llm.shared import new_path, stored

#: Buckets for each task, and keys that any bucket may hold before it splits.
SHARE, LEAST = 4, 256
#: Bytes of distinct texts that a map task combines before it passes them on.
COMBINE_BYTES = 24 << 20

_TEXTS = "owner int, h long, bucket int, sha binary, norm binary, keep_id long, n long"
_INDEX = "h long, bucket int, chain int, sha binary, keep_id long, group_size long"


def _digest(text: str | None) -> tuple[bytes, bytes, int]:
    norm = single_spaced((text or "").encode())
    sha = hashlib.sha256(norm).digest()
    return norm, sha, int.from_bytes(sha[:8], "big", signed=True)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = [_digest(t)[1:] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([h for _, h in found], pa.int64()), pa.array([s for s, _ in found], pa.binary())], ["doc_id", "h", "sha"])


def grow_directory(cells: dict[int, int], depth: int, capacity: int) -> np.ndarray:
    """Double the directory until no bucket exceeds ``capacity``; the bucket of every cell of ``depth`` leading bits.

    ``cells`` counts keys by their leading ``depth`` bits.  A bucket of local
    depth d owns the 2**(depth - d) neighbouring cells that share d bits.
    """
    counts = np.zeros(1 << depth, np.int64)
    for cell, n in cells.items():
        counts[cell] = n
    first = np.zeros(1, np.int64)
    width = 1 << depth
    full = np.concatenate(([0], np.cumsum(counts)))
    done: list[np.ndarray] = []
    while len(first):
        over = (full[first + width] - full[first] > capacity) & (width > 1)
        done.append(first[~over])
        width //= 2
        first = np.concatenate((first[over], first[over] + width))
    starts = np.sort(np.concatenate(done))
    return (np.searchsorted(starts, np.arange(1 << depth), side="right") - 1).astype(np.int32)


def _combiner(directory: np.ndarray, owners: np.ndarray, depth: int):
    names = [c.split()[0] for c in _TEXTS.split(", ")]
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = []
            for i, (norm, (sha, h, keep, n)) in enumerate(held.items(), 1):
                bucket = int(directory[(h & 0xFFFFFFFFFFFFFFFF) >> (64 - depth)]) if depth else 0
                rows.append((int(owners[bucket]), h, bucket, sha, norm, keep, n))
                if len(rows) == 1000 or i == len(held):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []

        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    norm, sha, h = _digest(text)
                    if (own := held.get(norm)) is None:
                        held[norm] = [sha, h, doc_id, 1]
                        size += len(norm) + 200
                    else:
                        own[2] = doc_id if own[2] is None else own[2] if doc_id is None else min(own[2], doc_id)
                        own[3] += 1
                if size > COMBINE_BYTES:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return run


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys arrive in hash order; equal hashes form a chain whose entries differ in their bytes."""
    now, bucket, chain = None, 0, []

    def rows(out: list) -> None:
        if len({c[1] for c in chain}) < len(chain):
            raise ValueError("two different texts share one SHA-256")
        out.extend((now, bucket, i, sha, keep, n) for i, (_, sha, keep, n) in enumerate(chain))

    def pack(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["h", "bucket", "chain", "sha", "keep_id", "group_size"])

    for batch in batches:
        out: list = []
        for h, own, sha, norm, keep, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if h != now:
                if chain:
                    rows(out)
                now, bucket, chain = h, own, []
            for entry in chain:
                if entry[0] == norm:
                    entry[2] = entry[2] if keep is None else keep if entry[2] is None else min(entry[2], keep)
                    entry[3] += n
                    break
            else:
                chain.append([norm, sha, keep, n])
        if out:
            yield pack(out)
    if chain:
        out = []
        rows(out)
        yield pack(out)


def build_index(plain: DataFrame, keys: DataFrame, path: str, capacity: int | None = None) -> None:
    """Write the index of ``plain`` (``doc_id, text``), whose keys are ``keys``: ``directory`` and ``buckets`` below ``path``."""
    spark = plain.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = keys.count()
    capacity = capacity or max(LEAST, -(-rows // (SHARE * tasks)))
    depth = 0 if rows <= capacity else min(30, int(np.ceil(np.log2(rows / capacity))) + 3)
    cells = {}
    if depth:
        per_key = keys.groupBy("h").agg(F.lit(1).alias("one"))
        cells = {r[0]: r[1] for r in per_key.groupBy(F.shiftrightunsigned("h", 64 - depth).cast("long").alias("cell")).count().collect()}
    directory = grow_directory(cells, depth, capacity)
    buckets = int(directory[-1]) + 1
    tasks = min(tasks, buckets)
    owners = (np.arange(buckets) * tasks // buckets).astype(np.int32)
    table = pd.DataFrame({"cell": np.arange(len(directory)), "bucket": directory.astype(np.int64), "owner": owners[directory].astype(np.int64)})
    spark.createDataFrame(table).write.parquet(f"{path}/directory")
    owned = plain.mapInArrow(_combiner(directory, owners, depth), _TEXTS).repartitionById(tasks, F.col("owner")).sortWithinPartitions("h").drop("owner")
    owned.mapInArrow(_chains, _INDEX).write.parquet(f"{path}/buckets")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keys = stored(plain.mapInArrow(_keys, "doc_id long, h long, sha binary"), "exact-keys")
    path = new_path(spark, "exact-index")
    build_index(plain, keys, path, capacity)
    index = spark.read.schema(_INDEX).parquet(f"{path}/buckets").select("h", "sha", "keep_id", "group_size")
    share = max(1, keys.count() // int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(index.filter(F.col("group_size") > share))  # fewer rows than partitions
    rest = keys.join(hot.select("h", "sha"), ["h", "sha"], "left_anti").join(index.filter(F.col("group_size") <= share), ["h", "sha"])
    found = keys.join(hot, ["h", "sha"]).unionByName(rest)
    return found.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select("doc_id", F.col("text_sha256").alias("sha")).distinct()
    norm = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.sha2(norm, 256).alias("sha"), F.struct("*").alias("row"))
    return own.join(kept, (own["sha"] == kept["sha"]) & own["id"].eqNullSafe(kept["doc_id"]), "left_semi").select("row.*")
