"""Near-duplicate classes by SetSketch registers, banding, joint likelihood and full checks.

A document's set is its distinct shingles of ``width`` words (lower-cased A-Z).
Each shingle throws points on a half line at exponential distances, each point
onto a random register; a register keeps the smallest point as a truncated
logarithm (base ``B``).  Registers of a union are register-wise maxima, so
sketches merge, and two registers agree with a probability close to the
Jaccard similarity.

1. Documents with equal sets form a class.
2. ``BANDS`` bands of ``ROWS`` register values are the bucket keys.
3. In each bucket every class meets the bucket's pivot (a random member), a few
   bands at a time; classes already connected are not compared again.
4. A pair is dropped only if the joint likelihood of its registers and exact
   set sizes at the wanted similarity is e**-``DOUBT`` or less of the maximum;
   all others are compared on their full sets, made from their texts.
5. Buckets whose members are still in several components are then searched
   completely: members outside the bucket's main component against all others,
   in blocks, each pair at most once.  A first pass over registers alone finds
   the members that have any likely partner; only their texts are fetched, in
   blocks by bytes, and compared.  So no link between bucket mates is lost to
   the choice of pivots.

A pair at exactly 0.8 shares no bucket with probability (1 - 0.8**5)**32, three
in a million; likelihood drops it with less than one in a million, and half its
registers differ (which the search passes over) with less than 1e-16.  A
shingle stands as two 64-bit hashes under different seeds: among m shingles two
different ones meet with a probability below m**2 / 2**129, 1e-14 for 1e12.

Results: null and empty texts, and texts without words, have an empty set and
are linked with nothing.  Fewer words than ``width`` are one shingle.  Texts of
any length are taken whole.  Rows are told apart by id and text, so one id may
stand on several texts; rows that repeat both are treated alike.  A null
``doc_id`` takes part and counts as larger than any other; where a component has
no other id, ``component_id`` is null.  An empty table gives an empty one.
Further columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.bytesops import lower_ascii, mix64, slices, span_hashes, text_bytes, word_spans
from readloom.llm.components import components
from readloom.llm.shared import stored

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
B, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 1
DOUBT = 12.0
#: Bands whose pivots are compared in one round.
ROUNDS = ((0, 2), (2, 8), (8, BANDS))
#: Members of a bucket in one block of the search over registers, and of the search over texts with their bytes.
BLOCK, TEXT_BLOCK, TEXT_BYTES = 1024, 512, 8 << 20
_SEEDS = (0x51, 0xA7)
_NO_ID = -(1 << 63)


def shingle_sets(batch: pa.RecordBatch, column: int, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and two 64-bit hashes of every distinct shingle, sorted by all three."""
    data, at = text_bytes(batch.column(column))
    data = lower_ascii(data)
    start, end, row = word_spans(data, at)
    words = np.bincount(row, minlength=batch.num_rows)
    first = np.cumsum(words) - words
    whole = np.arange(max(0, len(row) - width + 1))
    whole = whole[row[whole] == row[whole + width - 1]] if len(whole) else whole
    spots = [(whole, width)] + [(first[words == m], m) for m in range(1, width)]
    rows = np.concatenate([row[i] for i, _ in spots])
    both = []
    for seed in _SEEDS:
        word = span_hashes(data, start, end, seed)
        own = []
        for i, m in spots:
            h = np.full(len(i), m * 0x9E3779B97F4A7C15 + seed & 0xFFFFFFFFFFFFFFFF, np.uint64)
            for k in range(m):
                h = mix64((h ^ word[i + k]) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
            own.append(h)
        both.append(np.concatenate(own))
    one, two = both
    by = np.lexsort((one, rows))
    rows, one, two = rows[by], one[by], two[by]
    same = (rows[1:] == rows[:-1]) & (one[1:] == one[:-1])
    if (two[1:] != two[:-1])[same].any():
        by = np.lexsort((two, one, rows))
        rows, one, two = rows[by], one[by], two[by]
        same = (rows[1:] == rows[:-1]) & (one[1:] == one[:-1])
    new = np.ones(len(rows), bool)
    new[1:] = ~same | (two[1:] != two[:-1])
    return rows[new], one[new], two[new]


def set_sketches(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Registers of ``n`` sets, as a matrix of unsigned 16-bit integers (0 only for empty sets)."""
    sizes = np.bincount(rows, minlength=n)
    low = np.full((n, REGISTERS), np.inf)
    todo, want = np.flatnonzero(sizes), 8.0
    while len(todo):
        reach = np.zeros(n)
        reach[todo] = want / (RATE * sizes[todo])
        own = np.isin(rows, todo) if len(todo) < n else slice(None)
        r, h = rows[own], hashes[own]
        x = np.zeros(len(h))
        step = 0
        while len(h):
            step += 1
            draw = mix64(h + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            x = x - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / (RATE * REGISTERS)
            near = x <= reach[r]
            r, h, x, draw = r[near], h[near], x[near], draw[near]
            spot = (mix64(draw ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)
            np.minimum.at(low.reshape(-1), r * REGISTERS + spot.astype(np.int64), x)
        todo = np.flatnonzero((sizes > 0) & np.isinf(low).any(axis=1))
        want *= 2
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(low) / np.log(B))
    return np.where(np.isinf(low), 0, np.clip(value, 1, LIMIT)).astype(np.uint16)


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows, one, two = shingle_sets(batch, 1, width)
                n = batch.num_rows
                size = np.bincount(rows, minlength=n)
                first = np.concatenate(([0], np.cumsum(size)))
                prints = []
                for hashes in (one, two):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(hashes + np.uint64(0x1234567)))))
                    prints.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
                registers = set_sketches(rows, one, n).tobytes()
                step = 2 * REGISTERS
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(prints[0]), pa.array(prints[1]), pa.array([registers[i * step : (i + 1) * step] for i in range(n)], pa.binary())],
                    ["id", "sha", "n", "f1", "f2", "regs"],
                )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        regs = _matrix(batch.column(1)).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.full(regs.shape[:2], 0x2545F4914F6CDD1D, np.uint64)
        for i in range(ROWS):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + regs[:, :, i])
        key = key >> np.uint64(5) << np.uint64(5) | np.arange(BANDS, dtype=np.uint64)
        ids = np.repeat(np.asarray(batch.column(0)), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(ids)], ["key", "cls"])


def maybe_linked(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, per_cent: int = 80) -> np.ndarray:
    """Whether the joint likelihood leaves room for the wanted similarity, pair by pair."""
    na, nb = na.astype(float), nb.astype(float)
    fits = 100 * np.minimum(na, nb) >= per_cent * np.maximum(na, nb)
    up, down = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    same = REGISTERS - up - down
    u, v = na / (na + nb), nb / (na + nb)
    most = np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (B - 1) / B) / np.log(B)

    def likelihood(j: np.ndarray) -> np.ndarray:
        a, b = p(np.maximum(u - v * j, 1e-9)), p(np.maximum(v - u * j, 1e-9))
        return up * np.log(a) + down * np.log(b) + same * np.log(np.maximum(1 - a - b, 1e-9))

    line = per_cent / 100
    at = likelihood(np.minimum(line, most))
    below = np.full(len(na), -np.inf)
    for j in np.linspace(0, line, 11):  # a coarse maximum is a lower one, so fewer pairs are dropped
        below = np.maximum(below, likelihood(np.minimum(j, most)))
    return fits & (below - at <= DOUBT)


def _likely(per_cent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, ra, rb, na, nb = batch.columns
                ok = maybe_linked(_matrix(ra), _matrix(rb), np.asarray(na), np.asarray(nb), per_cent)
                yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(ok))

    return run


def linked(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], per_cent: int = 80) -> bool:
    """Whether two sets, sorted by their first hashes, are similar enough."""
    if any((s[0][1:] == s[0][:-1]).any() for s in (x, y)):  # one first hash on two shingles
        both = len(set(zip(*(c.tolist() for c in x), strict=True)) & set(zip(*(c.tolist() for c in y), strict=True)))
    else:
        at = np.minimum(np.searchsorted(y[0], x[0]), max(len(y[0]) - 1, 0))
        both = int(((y[0][at] == x[0]) & (y[1][at] == x[1])).sum()) if len(y[0]) else 0
    return 100 * both >= per_cent * (len(x[0]) + len(y[0]) - both)


def _sets_of(batch: pa.RecordBatch, column: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rows, one, two = shingle_sets(batch, column, width)
    edges = np.searchsorted(rows, np.arange(batch.num_rows + 1)).tolist()
    return [(one[a:b], two[a:b]) for a, b in itertools.pairwise(edges)]


def _checked(width: int, per_cent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "ta"):
                ok = [linked(x, y, per_cent) for x, y in zip(_sets_of(batch, 2, width), _sets_of(batch, 3, width), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _search(width: int, per_cent: int, texts: bool):
    """A block of a bucket's outsiders against a block of its members.

    A pair is looked at in the first bucket that it shares.  Without texts the
    result names the members that have a likely partner in another component;
    with them it is the links between components that full sets confirm, and
    components joined in the block are not compared again.
    """

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        out, rest = block[block["side"] == 0], block[block["side"] == 1]
        ra, rb = (np.frombuffer(b"".join(x["regs"]), np.uint16).reshape(len(x), REGISTERS) for x in (out, rest))
        comp, ids, sizes = rest["comp"].to_numpy(), rest["cls"].to_numpy(), rest["n"].to_numpy()
        own_text, their_text = (x["text"].tolist() if texts else None for x in (out, rest))
        root: dict[int, int] = {}
        sets: dict[int, tuple] = {}
        met = np.zeros(len(rest), bool)
        links = []

        def top(c: int) -> int:
            while c in root:
                c = root[c]
            return c

        def made(text: str) -> tuple[np.ndarray, np.ndarray]:
            return _sets_of(pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"]), 0, width)[0]

        for i, (cls, own, n) in enumerate(zip(out["cls"].tolist(), out["comp"].tolist(), out["n"].tolist(), strict=True)):
            near = np.flatnonzero((comp != own) & (100 * np.minimum(sizes, n) >= per_cent * np.maximum(sizes, n)))
            same = ra[i] == rb[near]
            alike = np.count_nonzero(same, axis=1)
            half = np.flatnonzero(alike >= REGISTERS // 2)
            half = half[same[half].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == (key[0] & (BANDS - 1))]
            near, alike = near[half], alike[half]
            if len(near):
                ok = maybe_linked(np.broadcast_to(ra[i], (len(near), REGISTERS)), rb[near], np.full(len(near), n), sizes[near], per_cent)
                near, alike = near[ok], alike[ok]
            if not len(near):
                continue
            if not texts:
                met[near] = True
                links.append(cls)
                continue
            x = None
            for j in near[np.argsort(-alike, kind="stable")].tolist():
                a, b = top(own), top(int(comp[j]))
                if a == b:
                    continue
                x = made(own_text[i]) if x is None else x
                if j not in sets:
                    sets[j] = made(their_text[j])
                if linked(x, sets[j], per_cent):
                    root[max(a, b)] = min(a, b)
                    links.append((cls, int(ids[j])))
        if not texts:
            return pd.DataFrame({"key": key[0], "cls": np.unique(np.concatenate((np.array(links, np.int64), ids[met])))})
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _blocks(rows: DataFrame, size: int, cols: list[str]) -> DataFrame:
    """Rows of buckets (``key, cls, comp``, and ``bytes``) dealt to blocks: outsiders (side 0) meet every block of members (side 1)."""
    per = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("bytes").alias("bytes")).groupBy("key")
    per = per.agg(F.max(F.struct("k", F.col("comp").alias("main"), "bytes")).alias("m"), F.sum("k").alias("k"), F.sum("bytes").alias("bytes"))
    parts = lambda k, n: F.greatest(F.ceil(k / size), F.ceil(n / TEXT_BYTES), F.lit(1)).cast("long")
    per = per.select("key", F.col("m.main").alias("main"), parts(F.col("k"), F.col("bytes")).alias("blocks"), parts(F.col("k") - F.col("m.k"), F.col("bytes") - F.col("m.bytes")).alias("outs"))
    met = rows.join(per, "key")
    left = met.filter("comp <> main").withColumns({"side": F.lit(0), "oblock": F.pmod(F.xxhash64("cls", F.lit(1)), "outs"), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))})
    right = met.withColumns({"side": F.lit(1), "block": F.pmod(F.xxhash64("cls"), "blocks"), "oblock": F.explode(F.sequence(F.lit(0).cast("long"), F.col("outs") - 1))})
    cols = ["key", *cols, "side", "oblock", "block"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # blocks are small and take long, so they aren't put together by size
    return left.select(*cols).unionByName(right.select(*cols)).repartition(parts, "key", "oblock", "block").groupBy("key", "oblock", "block")


def _classes(docs: DataFrame, width: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their texts, rows with their sketches, and the classes of equal sets."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("sha"))
    sketched = stored(plain.mapInArrow(_sketch(width), "id long, sha binary, n long, f1 long, f2 long, regs binary"), "near-sketches")
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "sha")).alias("low")
    classes = sketched.filter("n > 0").groupBy("n", "f1", "f2").agg(least, F.min("regs").alias("regs"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "near-classes")
    return plain, sketched, classes


def near_rows(docs: DataFrame, width: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, sha`` (of the text), ``n`` (set size), and ``low`` (``no_id, id, sha`` of the least document of its component; null for empty sets)."""
    plain, sketched, classes = _classes(docs, width, id_col, text_col)
    sketch = classes.select("cls", "n", "regs")
    keys = stored(sketch.select("cls", "regs").mapInArrow(_bands, "key long, cls long"), "near-bands")
    many = keys.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("key")
    buckets = stored(keys.join(many, "key"), "near-buckets")
    mates = buckets.select("cls").distinct()
    key = F.coalesce("id", F.lit(_NO_ID))
    wanted = classes.join(mates, "cls", "left_semi").select("cls", F.coalesce("low.id", F.lit(_NO_ID)).alias("k"), "low.sha")
    texts = stored(plain.select(key.alias("k"), "sha", "text").join(wanted, ["k", "sha"]).dropDuplicates(["k", "sha"]).select("cls", "text"), "near-texts")
    comp = stored(mates.withColumn("comp", F.col("cls")), "near-comp")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (texts.select(F.col("cls").alias(x), F.col("text").alias("t" + x)) for x in "ab")
        return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(_checked(width, per_cent), "a long, b long")

    def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
        links = stored(links, "near-links")
        if links.isEmpty():
            return comp
        of = comp.select(F.col("cls"), F.col("comp"))
        edges = links.join(of.withColumnsRenamed({"cls": "a", "comp": "ca"}), "a").join(of.withColumnsRenamed({"cls": "b", "comp": "cb"}), "b")
        new = components(edges.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "near-components").withColumnRenamed("comp", "low")
        return stored(comp.join(new, comp["comp"] == new["node"], "left").select("cls", F.coalesce("low", "comp").alias("comp")), "near-comp")

    for low, high in ROUNDS:
        band = F.col("key").bitwiseAND(F.lit(BANDS - 1))
        members = buckets.filter((band >= low) & (band < high)).join(comp, "cls")
        pivot = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("cls", "key").alias("h"), "cls", "comp")).alias("p"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key", F.col("p.cls").alias("pc"), F.col("p.comp").alias("pcomp"))
        pairs = members.join(pivot, "key").filter("comp <> pcomp").select(F.least("cls", "pc").alias("a"), F.greatest("cls", "pc").alias("b")).distinct()
        ra, rb = (sketch.withColumnsRenamed({"cls": x, "regs": "r" + x, "n": "n" + x}) for x in "ab")
        likely = pairs.join(ra, "a").join(rb, "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(_likely(per_cent), "a long, b long")
        comp = merged(comp, verified(likely))

    members = buckets.join(comp, "cls")
    span = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    live = members.join(span, "key").join(sketch, "cls").withColumn("bytes", F.lit(2 * REGISTERS).cast("long"))
    live = stored(live.select("key", "cls", "comp", "n", "regs", "bytes"), "near-live")
    found = _blocks(live, BLOCK, ["cls", "comp", "n", "regs"]).applyInPandas(_search(width, per_cent, False), "key long, cls long")
    found = stored(found.distinct(), "near-found")
    rows = live.drop("bytes").join(found, ["key", "cls"]).join(texts, "cls").withColumn("bytes", F.octet_length("text").cast("long"))
    comp = merged(comp, _blocks(rows, TEXT_BLOCK, ["cls", "comp", "n", "regs", "text"]).applyInPandas(_search(width, per_cent, True), "a long, b long"))

    own = classes.select("cls", "n", "f1", "f2", "low").join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    of = own.join(own.groupBy("comp").agg(F.min("low").alias("least")), "comp").select("n", "f1", "f2", F.col("least").alias("low"))
    return sketched.select("id", "sha", "n", "f1", "f2").join(of, ["n", "f1", "f2"], "left").select("id", "sha", "n", "low")


def _agreeing(per_cent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alike = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1)
                yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(100 * alike >= per_cent * REGISTERS))

    return run


def sketch_rows(docs: DataFrame, width: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, sha, low`` as ``near_rows`` gives them, by estimates from the sketches alone.

    Classes are linked with the smallest class of each of their buckets where
    ``per_cent`` of the registers agree; texts are not compared.  A tenth of
    the stages of ``near_rows``, for uses where a few links near the limit more
    or less do no harm (its standard error at 0.8 is 0.03).
    """
    _, sketched, classes = _classes(docs, width, id_col, text_col)
    classes = classes.withColumn("cls", F.xxhash64("n", "f1", "f2"))  # the same in every run, so the links are too
    sketch = classes.select("cls", "regs")
    keys = stored(sketch.mapInArrow(_bands, "key long, cls long"), "near-bands")
    low = keys.groupBy("key").agg(F.min("cls").alias("b"), F.max("cls").alias("hi")).filter("b < hi").select("key", "b")
    pairs = keys.join(low, "key").filter("cls <> b").select(F.col("cls").alias("a"), "b").distinct()
    ra, rb = (sketch.withColumnsRenamed({"cls": x, "regs": "r" + x}) for x in "ab")
    links = pairs.join(ra, "a").join(rb, "b").select("a", "b", "ra", "rb").mapInArrow(_agreeing(per_cent), "a long, b long")
    comp = components(links, "near-components").withColumnRenamed("node", "cls")
    own = classes.select("cls", "n", "f1", "f2", F.col("low").alias("least")).join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    of = own.join(own.groupBy("comp").agg(F.min("least").alias("low")), "comp").select("n", "f1", "f2", "low")
    return sketched.select("id", "sha", "n", "f1", "f2").join(of, ["n", "f1", "f2"], "left").select("id", "sha", "low")


def near_classes(docs: DataFrame, width: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    component = F.when(F.col("low").isNull(), F.col("id")).otherwise(F.col("low.id"))
    return near_rows(docs, width, per_cent, id_col, text_col).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, width: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document of the smallest id (then text hash) of each class of near copies, with all its columns; rows that repeat its id and text stay with it."""
    rows = near_rows(docs, width, per_cent, id_col, text_col)
    stays = F.col("low").isNull() | (F.col("id").eqNullSafe(F.col("low.id")) & (F.col("sha") == F.col("low.sha")))
    kept = rows.filter(stays).select(F.coalesce("id", F.lit(_NO_ID)).alias("id"), "sha").distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.unhex(F.sha2(text, 256)).alias("sha"), F.struct("*").alias("row"))
    return own.join(kept, ["id", "sha"], "left_semi").select("row.*")
