"""Token-id shards with minimal perfect hash indexes.

Documents are encoded, sorted by ``doc_id`` and packed into shards.  A shard is
one row of a Parquet table, so any store Spark can write to will do:

``range`` and ``shard`` (its place in the order), ``before`` (ids of its range
before it), ``first_id``/``last_id``, ``docs``, ``tokens``, ``payload`` (all
ids, little-endian unsigned integers of ``width`` bytes, without gaps) and an
index for keyed access: a minimal perfect hash over the document keys, and for
each of its values a 32-bit fingerprint, the offset and the length in the
payload.

The hash is a cascade of bit arrays: keys that fall alone on a bit of a level
own it, the others go to the next, smaller level; a key's value is the number
of bits set before its own, which a stored count for every 64 bits gives at
once.  A lookup reads one bit for each level it passes, one count and one slot,
whatever the shard's size; a foreign key that lands on a slot by chance is
refused by its fingerprint.

Rows are cut into ranges of ``doc_id`` by quantiles, one range for each task.
An id that fills several ranges (a null id, say) is dealt to them by a hash of
its token ids, so it is no one task's burden; rows that are equal in id and
text stay in one range.  Shards are cut by size wherever they stand.

Results: rows with one ``doc_id`` lie side by side, ordered by that hash and
their ids; the key leads to the first of them in each shard and says how many
there are.  A null ``doc_id`` sorts first and has no key.  Null and empty text
count as just the end id.  An empty table gives no shard.  Texts of any length
are encoded whole; one that exceeds a shard's size is a shard of its own.
Further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.llm.bytesops import mix64, slices
from readloom.llm.shared import new_path
from readloom.llm.word_bpe import AT_ONCE, encoder, release, texts_of

#: Bytes of ids in a shard, unless one document has more.
SHARD_BYTES = 1 << 19
#: Documents of one key range (the unit that a task sorts), at most and at least.
RANGE_DOCS, LEAST_DOCS = 32_768, 256
LEVELS = 24
_LOWEST = -(1 << 63)

#: Payloads are written without a dictionary and in small row groups, so that neither writing nor reading holds many of them.
FILES = {"compression": "lz4_raw", "parquet.enable.dictionary": "false", "parquet.block.size": str(4 << 20)}

_INDEX = "doc_ids binary, lengths binary, bits binary, ranks binary, level_sizes binary, prints binary, slots binary"
SHARD = f"range int, shard int, before long, first_id long, last_id long, docs int, tokens long, width int, payload binary, {_INDEX}"


def _spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mix64(keys.astype(np.uint64) ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys; ``values`` are 0 .. n-1 for them, -1 or any for others.

    ``bits`` are words of 64 bits, ``ranks`` the bits set before each word.
    """

    def __init__(self, bits: np.ndarray, ranks: np.ndarray, sizes: np.ndarray):
        self.bits, self.ranks, self.sizes = bits, ranks, sizes
        self.starts = np.concatenate(([0], np.cumsum(sizes)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, parts = keys.astype(np.uint64), [], []
        while len(left):
            level = len(sizes)
            if level == LEVELS:
                raise ValueError("keys are not distinct")
            size = -(-max(64, 2 * len(left)) // 64) * 64
            spot = _spot(left, level, size)
            alone = np.bincount(spot, minlength=size) == 1
            parts.append(alone)
            sizes.append(size)
            left = left[~alone[spot]]
        bits = np.packbits(np.concatenate(parts), bitorder="little").view("<u8") if parts else np.zeros(0, "<u8")
        ranks = np.cumsum(np.bitwise_count(bits), dtype=np.int64)
        return cls(bits, (ranks - np.bitwise_count(bits)).astype("<u4"), np.array(sizes, np.int64))

    def values(self, keys: np.ndarray) -> np.ndarray:
        out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = self.starts[level] + _spot(keys[rest], level, size)
            word, bit = self.bits[at >> 6], np.uint64(1) << (at & 63).astype(np.uint64)
            hit = word & bit != 0
            out[rest[hit]] = self.ranks[at[hit] >> 6] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
            rest = rest[~hit]
        return out


def _shard_row(rng: int, seq: int, before: int, rows: list[tuple], width: int) -> dict:
    ids = np.array([r[0] if r[0] is not None else 0 for r in rows], np.int64)
    real = np.array([r[0] is not None for r in rows])
    lengths = np.array([len(r[1]) // width for r in rows], np.int64)
    start = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    new = real.copy()
    new[1:] &= (ids[1:] != ids[:-1]) | ~real[:-1]
    heads = np.flatnonzero(new)
    keys = ids[heads]
    many = np.diff(np.concatenate((heads, [len(rows)])))
    h = PerfectHash.build(keys)
    order = h.values(keys)
    prints, slots = np.zeros(len(keys), np.uint32), np.zeros((len(keys), 4), np.int64)
    prints[order] = fingerprint(keys)
    slots[order] = np.column_stack((start[heads], lengths[heads], heads, many))
    return {
        "range": rng, "shard": seq, "before": before, "first_id": rows[0][0], "last_id": rows[-1][0], "docs": len(rows), "tokens": int(lengths.sum()), "width": width,
        "payload": b"".join(r[1] for r in rows), "doc_ids": np.where(real, ids, 0).tobytes() + real.tobytes(), "lengths": lengths.tobytes(),
        "bits": h.bits.tobytes(), "ranks": h.ranks.tobytes(), "level_sizes": h.sizes.tobytes(), "prints": prints.tobytes(), "slots": slots.tobytes(),
    }


def _packer(small: str):
    """Packs rows that arrive in order; ``small`` is the width of the ids on their way."""
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 8
    width = np.dtype(small).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        now, seq, before, held, size = None, 0, 0, [], 0

        def out() -> pa.RecordBatch:
            row = _shard_row(now, seq, before, held, width)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds, strict=True)], list(row))

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for rng, doc_id, raw in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                    if held and (rng != now or size + len(raw) > SHARD_BYTES):
                        yield out()
                        seq, before = (seq + 1, before + size // width) if rng == now else (0, 0)
                        held, size = [], 0
                    now = rng
                    held.append((doc_id, raw))
                    size += len(raw)
        if held:
            yield out()

    return run


def _range_of(bounds: np.ndarray, keys: np.ndarray, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Range of each row, and the order of rows of one id that fills several ranges (0 for other ids)."""
    low, high = np.searchsorted(bounds, keys, side="left"), np.searchsorted(bounds, keys, side="right")
    order = np.zeros(len(keys), np.int64)
    for i in np.flatnonzero(high - low > 1).tolist():
        order[i] = int.from_bytes(blake2b(raw[i], digest_size=4).digest(), "big")
    return low + ((high - low) * order >> 32), order


def write_shards(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document, append ``end_id`` and write shards in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(_LOWEST)).alias("doc_id"))
    n = ids.count()
    parts = max(1, min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // RANGE_DOCS)), n // LEAST_DOCS))
    cuts = [float(c) for c in np.arange(1, parts) / parts]
    bounds = np.array(ids.agg(F.percentile_approx("doc_id", cuts, 10 * parts)).first()[0] if cuts else [], np.int64)
    small = "<u2" if max(end_id, *encoder(tokenizer_path).names) < 1 << 16 else "<u4"
    width = np.dtype(small).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text", AT_ONCE):
                ids, offsets = e.encode_all([t or "" for t in part.column(1).to_pylist()])
                whole = np.insert(ids, offsets[1:], end_id).astype(small).tobytes()
                places = ((offsets + np.arange(len(offsets))) * width).tolist()
                raw = [whole[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
                own, order = _range_of(bounds, np.asarray(part.column(0).fill_null(_LOWEST)), raw)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), part.column(0), pa.array(order), pa.array(raw, pa.binary())], ["range", "doc_id", "order", "ids"])
            pa.default_memory_pool().release_unused()

    encoded = texts_of(docs, id_col, text_col).mapInArrow(run, "range int, doc_id long, order long, ids binary")
    ranged = encoded.repartitionById(parts, F.col("range")).sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "order", "ids")
    ranged.select("range", "doc_id", "ids").mapInArrow(_packer(small), SHARD).write.options(**FILES).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    A document's offset and length come from its key's slot; only rows that
    share their id with others, or have none, take them from their place.  The
    driver holds one number for each range.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    totals = dict(shards.groupBy("range").agg(F.sum("tokens")).collect())
    ranges = max(totals, default=-1) + 1
    ahead = np.concatenate(([0], np.cumsum([totals.get(r, 0) for r in range(ranges)]))).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, real, lengths = _documents(row)
                start = np.concatenate(([0], np.cumsum(lengths)))[:-1]
                found = locate(row, ids)
                if (real & (found[:, 3] < 1)).any():
                    raise ValueError("a stored key isn't found through its index")
                own = real & (found[:, 3] == 1)
                start, lengths = np.where(own, found[:, 0], start), np.where(own, found[:, 1], lengths)
                raw = _wide(row["payload"], row["width"])
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(start.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~real), pa.array(start + row["before"] + ahead[row["range"]]), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
            pa.default_memory_pool().release_unused()

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _wide(raw: bytes, width: int) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return raw if width == 4 else np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()


def _documents(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = row["docs"]
    return np.frombuffer(row["doc_ids"][: 8 * n], np.int64), np.frombuffer(row["doc_ids"][8 * n :], bool), np.frombuffer(row["lengths"], np.int64)


def locate(row: dict, keys: np.ndarray) -> np.ndarray:
    """Through a shard's index: offset and length in ids, first document, number of documents of each key; (-1, -1, -1, 0) if it isn't there."""
    value = PerfectHash(np.frombuffer(row["bits"], "<u8"), np.frombuffer(row["ranks"], "<u4"), np.frombuffer(row["level_sizes"], np.int64)).values(keys)
    prints, slots = np.frombuffer(row["prints"], np.uint32), np.frombuffer(row["slots"], np.int64).reshape(-1, 4)
    out = np.tile(np.array([-1, -1, -1, 0]), (len(keys), 1))
    hit = np.flatnonzero(value >= 0)
    hit = hit[prints[value[hit]] == fingerprint(keys[hit])]
    out[hit] = slots[value[hit]]
    return out


def lookup(spark: SparkSession, path: str, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Keyed access: ``doc_id, ids`` (one row per stored document) for a table of keys; null keys find nothing.

    A key goes to the ranges that reach over it (the driver holds two ids for
    each range), within a range to the last shard that begins before it, and to
    every shard that begins with it.  A task then holds one shard at a time,
    and its keys stream by.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    heads = shards.filter("last_id is not null").select("range", "shard", F.coalesce("first_id", F.lit(_LOWEST)).alias("first_id"), "last_id")
    limits = sorted(tuple(r) for r in heads.groupBy("range").agg(F.min("first_id"), F.max("last_id")).collect())
    number, low, high = (np.array([r[c] for r in limits], np.int64) for c in range(3))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.asarray(batch.column(0))
            a, b = np.searchsorted(high, k, side="left"), np.searchsorted(low, k, side="right")
            n = np.maximum(b - a, 0)
            at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(k, n)), pa.array(number[at], pa.int32())], ["k", "range"])

    wanted = keys.select(F.col(id_col).cast("long").alias("k")).filter("k is not null").distinct().mapInArrow(deal, "k long, range int")
    both = wanted.unionByName(heads.withColumnRenamed("first_id", "k"), allowMissingColumns=True)
    inside = F.last(F.when(F.col("shard").isNotNull(), F.struct("shard", "last_id")), True).over(Window.partitionBy("range").orderBy("k", F.col("shard").asc_nulls_first()))
    dealt = both.withColumn("h", inside).filter("shard is null and h.last_id >= k").select("range", "h.shard", "k")
    opened = wanted.join(heads.withColumnRenamed("first_id", "k"), ["range", "k"]).select("range", "shard", "k")
    asked = dealt.unionByName(opened).distinct()
    rows = shards.join(asked.select("range", "shard").distinct(), ["range", "shard"], "left_semi")
    met = rows.unionByName(asked, allowMissingColumns=True).repartition("range", "shard").sortWithinPartitions("range", "shard", F.col("k").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, start = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                now = batch.slice(i, 1).to_pylist()[0]
                if now["k"] is None:
                    row = now
                    start = np.concatenate(([0], np.cumsum(_documents(row)[2]))) * row["width"]
                    continue
                _, _, first, many = locate(row, np.array([now["k"]]))[0].tolist()
                raw = [_wide(row["payload"][start[d] : start[d + 1]], row["width"]) for d in range(first, first + many)]
                if raw:
                    yield pa.RecordBatch.from_arrays([pa.array([now["k"]] * many, pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "ids"])

    return met.mapInArrow(run, "doc_id long, ids binary")


def shard_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write the shards of ``docs`` to the shared folder and read every document back."""
    path = new_path(docs.sparkSession, "token-shards")
    write_shards(docs, tokenizer_path, path, end_id)
    return read_shards(docs.sparkSession, path)
