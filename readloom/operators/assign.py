"""Assignment of reads to references by shared k-mers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: K-mers of all references up to which they are sent to every executor (some 16 bytes each).
SEEDS = 500_000
#: Tasks that a crowded k-mer or sequence is dealt out to.
SALTS = 16
#: Bytes of sequences that a task looks at together.
AT_ONCE = 1 << 20


def kmers(seq: str, k: int) -> Column:
    """Distinct k-mers of a sequence column; a look-ahead walks the text once, where substrings by position would walk it for each."""
    return F.array_distinct(F.regexp_extract_all(F.col(seq), F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1)))


def seed_assign(reads: DataFrame, refs: DataFrame, k: int = 13) -> DataFrame:
    """The reference that shares most distinct k-mers with each read (ties by name); ``*`` if none does.

    References are counted first.  Up to ``SEEDS`` k-mers they are broadcast as
    numbers, and a read is assigned where it is, without a shuffle.  Beyond that
    (or for alphabets too large for that) both sides are joined on the k-mer.
    """
    seeds = refs.select("name", F.explode(kmers("seq", k)).alias("kmer"))
    found = seeds.limit(SEEDS + 1).collect()
    letters = sorted({c for r in found for c in r["kmer"]})
    bits = max(1, len(letters).bit_length())
    if len(found) <= SEEDS and k * bits <= 63 and "".join(letters).isascii():
        return _assign_here(reads, [(r["name"], r["kmer"]) for r in found], letters, bits, k)
    return _assign_joined(reads, seeds, k)


def _assign_joined(reads: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """The same by joins, for references of any number.

    The answer depends on the sequence alone, so each distinct one is looked up
    once, under its digest, and every row finds its answer by that; so repeated
    and null ids keep rows of their own.  A crowded k-mer or sequence is dealt
    out over ``SALTS``, where the small side (seeds, answers) is repeated.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    keyed = reads.select(F.col("read_id").cast("string").alias("read_id"), F.coalesce("seq", F.lit("")).alias("_seq")).withColumn("_key", F.sha2("_seq", 256))
    own = keyed.groupBy("_key").agg(F.min("_seq").alias("_seq")).select("_key", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int").alias("_salt"), F.explode(kmers("_seq", k)).alias("kmer"))
    shared = own.join(seeds.distinct().select("name", "kmer", salts), ["kmer", "_salt"]).groupBy("_key", "name").agg(F.count(F.lit(1)).alias("shared"))
    best = shared.groupBy("_key").agg(F.min(F.struct((-F.col("shared")).alias("less"), "name")).alias("_b"))
    rows = keyed.select("read_id", "_key", F.pmod(F.xxhash64("read_id"), F.lit(SALTS)).cast("int").alias("_salt"))
    found = rows.join(best.select("_key", "_b", salts), ["_key", "_salt"], "left")
    return found.select("read_id", F.coalesce("_b.name", F.lit("*")).alias("name"), F.coalesce(-F.col("_b.less"), F.lit(0).cast("long")).alias("shared"))


def _assign_here(reads: DataFrame, seeds: list[tuple[str, str]], letters: list[str], bits: int, k: int) -> DataFrame:
    """Look every read's k-mers up in sorted numbers; a letter that no reference has stands in no k-mer of theirs."""
    code = np.zeros(256, np.int64)
    code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    names = sorted({n for n, _ in seeds})
    place = {n: i for i, n in enumerate(names)}

    def numbers(data: np.ndarray) -> np.ndarray:
        """Number of the k-mer at each place; -1 where it holds a foreign letter."""
        own = code[data]
        out, odd = np.zeros(max(0, len(data) - k + 1), np.int64), np.zeros(max(0, len(data) - k + 1), bool)
        for j in range(k):
            part = own[j : j + len(out)]
            out = out << bits | part
            odd |= part == 0
        out[odd] = -1
        return out

    all_kmers = numbers(np.frombuffer("".join(s for _, s in seeds).encode(), np.uint8))[::k] if seeds else np.zeros(0, np.int64)
    owner = np.array([place[n] for n, _ in seeds], np.int64)
    by = np.lexsort((owner, all_kmers))
    table = reads.sparkSession.sparkContext.broadcast((all_kmers[by], owner[by]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners = table.value
        starts = np.flatnonzero(np.diff(keys, prepend=-2)) if len(keys) else np.zeros(0, np.int64)
        distinct, many = keys[starts], np.diff(np.append(starts, len(keys)))
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            groups = np.cumsum(size) // AT_ONCE
            for g in np.unique(groups).tolist():
                rows = np.flatnonzero(groups == g)
                data = np.frombuffer(b"".join(texts[i] for i in rows.tolist()), np.uint8)
                ends = np.cumsum(size[rows])
                found = numbers(data)
                row = np.searchsorted(ends, np.arange(len(found)), side="right")
                at = np.searchsorted(distinct, found)
                at[at == len(distinct)] = 0
                inside = np.arange(len(found)) + k <= ends[row] if len(found) else np.zeros(0, bool)
                hit = np.flatnonzero((distinct[at] == found) & inside) if len(distinct) else np.zeros(0, np.int64)
                pair = np.unique(row[hit] * max(len(distinct), 1) + at[hit])  # each k-mer once for a read
                own, seed = pair // max(len(distinct), 1), pair % max(len(distinct), 1)
                n = many[seed]
                spread = np.repeat(starts[seed] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                met, shared = np.unique(np.repeat(own, n) * max(len(names), 1) + owners[spread], return_counts=True)
                best = np.lexsort((met % max(len(names), 1), -shared, met // max(len(names), 1)))
                first, keep = np.unique((met // max(len(names), 1))[best], return_index=True)
                name, count = np.full(len(rows), -1), np.zeros(len(rows), np.int64)
                name[first], count[first] = (met % max(len(names), 1))[best][keep], shared[best][keep]
                out = [batch.column(0).take(pa.array(rows)), pa.array([names[i] if i >= 0 else "*" for i in name.tolist()], pa.string()), pa.array(count)]
                yield pa.RecordBatch.from_arrays(out, ["read_id", "name", "shared"])

    return reads.select(F.col("read_id").cast("string").alias("read_id"), "seq").mapInArrow(run, "read_id string, name string, shared long")
