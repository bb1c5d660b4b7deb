"""Column functions on sample arrays, sequences and CIGAR strings; Spark expressions, but for the decoding of qualities (Arrow)."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "array<double>"


def calibrate(raw: Column, rng: Column | float, digitisation: Column | float, offset: Column | float, start: int = 0, end: int | None = None) -> Column:
    """Picoampere values of samples ``start`` to ``end`` (clipped to the read)."""
    rng, digitisation, offset = (x if isinstance(x, Column) else F.lit(x) for x in (rng, digitisation, offset))
    size = F.size(raw) if end is None else F.least(F.lit(end), F.size(raw))
    part = F.slice(raw, F.lit(start + 1), F.greatest(size - start, F.lit(0)))
    return F.transform(part, lambda x: rng / digitisation * (x + offset))


def pool_mean(x: Column, pool: int) -> Column:
    """Mean of each ``pool`` samples; a rest at the end is dropped."""
    n = F.floor(F.size(x) / pool).cast("int")
    return F.when(n < 1, F.array().cast(EMPTY)).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.aggregate(F.slice(x, i * pool + 1, pool), F.lit(0.0), lambda s, v: s + v) / pool))


def pad_left(x: Column, n: int, filler: float) -> Column:
    """``x`` after as many fillers as it lacks to ``n``."""
    return F.concat(F.array_repeat(F.lit(float(filler)), F.greatest(F.lit(n) - F.size(x), F.lit(0))), x)


def tail_fit(x: Column, n: int, filler: float) -> Column:
    """Exactly ``n`` values: the last ones, or all behind fillers."""
    return pad_left(F.slice(x, F.greatest(F.size(x) - n, F.lit(0)) + 1, n), n, filler)


def head_pad(x: Column, limit: int, pool: int, n: int) -> Column:
    """The first ``limit`` samples (whole pools), pooled and padded with zeros on the left to ``n``."""
    return pad_left(pool_mean(F.slice(x, 1, limit // pool * pool), pool), n, 0.0)


def affine(x: Column, scale: Column, shift: Column) -> Column:
    return F.transform(x, lambda v: scale * v + shift)


def median_filter(x: Column, width: int) -> Column:
    """Running median of odd ``width`` with zeros beyond both ends."""
    half = width // 2
    padded = F.concat(F.array_repeat(F.lit(0.0), half), x, F.array_repeat(F.lit(0.0), half))
    middle = F.transform(F.sequence(F.lit(1), F.greatest(F.size(x), F.lit(1))), lambda i: F.element_at(F.array_sort(F.slice(padded, i, width)), half + 1))
    return F.when(F.size(x) > 0, middle).otherwise(x)


def median(x: Column) -> Column:
    """Median of an array; null for an empty one."""
    s, n = F.array_sort(x), F.size(x)
    low, high = F.floor((n + 1) / 2).cast("int"), F.floor((n + 2) / 2).cast("int")
    return F.when(n > 0, (F.element_at(s, F.greatest(low, F.lit(1))) + F.element_at(s, F.greatest(high, F.lit(1)))) / 2)


def mad_normalize(x: Column) -> Column:
    """``(x - median) / max(0.01, 1.4826 * MAD)``."""
    pair = F.array(F.struct(x.alias("x"), median(x).alias("m")))
    spread = F.transform(pair, lambda p: F.struct(p["x"].alias("x"), p["m"].alias("m"), F.greatest(F.lit(0.01), 1.4826 * median(F.transform(p["x"], lambda v: F.abs(v - p["m"])))).alias("d")))
    return F.element_at(F.transform(spread, lambda p: F.transform(p["x"], lambda v: (v - p["m"]) / p["d"])), 1)


def quality_decode(qual: Column, digits: int | None = None) -> Column:
    """Probability that each base is right, from Phred+33 characters; rounded half up to ``digits``, if given.

    A probability depends on its character alone, so it is computed (and
    rounded) once for each of the 128 ASCII characters and looked up where the
    texts are, an Arrow batch at a time; other characters are computed by value.
    """

    def chance(code: np.ndarray) -> np.ndarray:
        p = 1 - 10.0 ** (-(code - 33.0) / 10.0)
        return p if digits is None else np.array([float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) for v in p.tolist()])

    table = chance(np.arange(128.0))

    @F.arrow_udf("array<double>")
    def decode(texts: pa.Array) -> pa.Array:
        sizes = np.asarray(pc.fill_null(pc.utf8_length(texts), 0), np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), pc.fill_null(texts, "")), "")[0].as_py()
        code = np.frombuffer(whole.encode("utf-8" if whole.isascii() else "utf-32-le"), np.uint8 if whole.isascii() else np.uint32)
        p = table[np.minimum(code, 127)]
        beyond = np.flatnonzero(code > 127)
        p[beyond] = chance(code[beyond].astype(float))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(p), mask=texts.is_null())

    return decode(qual)


def to_dna(seq: Column) -> Column:
    return F.translate(seq, "U", "T")


def to_rna(seq: Column) -> Column:
    return F.translate(seq, "T", "U")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTU", "TGCAA"))


def match_length(cigar: Column) -> Column:
    """Sum of the lengths of all M operations."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit("([0-9]+)M"), F.lit(1)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def primary_part(name: Column) -> Column:
    """What stands before the first bar, unless the name starts with one."""
    return F.when(name.startswith("|"), name).otherwise(F.split(name, r"\|")[0])


def prefix_bucket(read_id: Column, n: int = 3) -> Column:
    return F.substring(read_id, 1, n)


def barcode_name(barcode: Column) -> Column:
    """``BC1`` ..., or ``undetermined`` for null."""
    return F.coalesce(F.concat(F.lit("BC"), (barcode + 1).cast("string")), F.lit("undetermined"))


def layout_path(label: Column, barcode: Column | None = None, kind: str = "fastq", suffix: str = ".fastq.gz") -> Column:
    """Output path of a group: by label, and by barcode if demultiplexed."""
    return F.concat(F.concat_ws("/", F.lit(kind), label, *([barcode_name(barcode)] if barcode is not None else [])), F.lit(suffix))
