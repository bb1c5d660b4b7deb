"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same fractional number of copies, target
divided by source size.  Whole copies are given at once.  The fractions are
then paired: of two documents, words move from one to the other, in a random
direction with unbiased odds, until one fraction is 0 or 1.  Each step keeps
the number of words taken.  Documents are paired inside salted blocks of a
source, largest first; what a block can't settle is one residual document, and
residuals meet in a reduction tree until one is left per source.

A large document must not be the residual, or its source misses the target by
much.  So a step's direction is random only while the documents behind can
still take up what the open one needs to become whole; when one direction would
leave it open for good, the other is taken.  What is left is a small document
(unless a source has none), which is rounded to the nearer side.

Draws come from hashes of the seed and the rows, so reruns agree however the
rows are partitioned.  Rows that are equal in all columns are interchangeable:
they are counted before any shuffle and told apart by their number.

Results: null and empty texts have size 0 and are never taken.  A null source is
a source of its own, last in order.  Rows that share an id, or repeat, are
rounded each.  An empty table gives an empty one.  Texts of any length are one
document.  Further columns travel along under any names.
"""

from __future__ import annotations

from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.shared import WORD, stored

#: Documents in a leaf block and residuals that meet in one node of the tree.
BLOCK, FAN_IN = 4096, 64
WEIGHTS = (5.0, 2.0, 1.0)
#: Equal rows that one row stands for when they are dealt to blocks.
RUN = 1024

_ROWS = "doc_id long, r1 long, r2 long, occ long, source string, size long, salt long, copies long, frac double"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, docs, target``: weights by source order, at most ``most`` times a source's size.

    Resharing the excess until no source is above ends at one level of words per
    weight: a source is full iff its own limit per weight is the level or less.
    Each round is one sum over the sources.  A source's place in order is its
    place in its sorted partition plus the sizes of the partitions before, so
    neither step needs all sources in one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("m").alias("docs"))
    per = stored(per.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "mix-order")
    part = F.shiftright("at", 33)
    counts = sorted(tuple(r) for r in per.groupBy(part.alias("part")).count().collect())  # one for each task of the sort
    ahead, before = {}, 0
    for number, n in counts:
        ahead[number], before = before, before + n
    start = F.element_at(F.create_map(*(F.lit(x) for pair in ahead.items() for x in pair)), part) if ahead else F.lit(0)
    place = start + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", "docs", weight.alias("w"), (F.col("source_size") * F.lit(float(most))).alias("lim"))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        is_full = F.col("lim") <= level * F.col("w")
        n, taken, open_ = per.agg(F.count_if(is_full), F.sum(F.when(is_full, F.col("lim"))), F.sum(F.when(~is_full, F.col("w")))).first()
        if n == full or not open_:
            break
        full, level = n, (share * total - (taken or 0.0)) / open_
    return per.select("source", "source_size", "docs", F.when(F.col("lim") <= level * F.col("w"), F.col("lim")).otherwise(level * F.col("w")).alias("target"))


def _draw(seed: int, *key: int) -> float:
    return int.from_bytes(blake2b("|".join(map(str, (seed, *key))).encode(), digest_size=7).digest(), "big") / 2**56


def settle(ids: list, sizes: list[int], fracs: list[float], seed: int, final: bool = False) -> tuple[list[int], list[float]]:
    """Pivotal rounding of one block, in the given order: 0/1 for each document, and fractions left (one at most, none if final)."""
    taken, left = [0] * len(ids), [-1.0] * len(ids)
    tiny = 1e-9
    live = [tiny < q < 1 - tiny for q in fracs]
    # words that the documents from each place on can give and take
    give, take = [0.0] * (len(ids) + 1), [0.0] * (len(ids) + 1)
    for j in range(len(ids) - 1, -1, -1):
        give[j] = give[j + 1] + live[j] * fracs[j] * sizes[j]
        take[j] = take[j + 1] + live[j] * (1 - fracs[j]) * sizes[j]

    def gap(p: float, size: int, j: int) -> float:
        """Words by which an open document stays away from a whole one, whatever the documents from ``j`` on do."""
        return 0.0 if p <= tiny or p >= 1 - tiny else max(0.0, min(p * size - take[j], (1 - p) * size - give[j]))

    i, p = -1, 0.0
    for j, q in enumerate(fracs):
        if not live[j]:
            taken[j] = int(q > 0.5)
            continue
        if i < 0:
            i, p = j, q
            continue
        si, sj = sizes[i], sizes[j]
        ways = []
        for move in (min((1 - p) * si, q * sj), -min(p * si, (1 - q) * sj)):  # words that can move to i, or from it to j
            pi, pj = p + move / si, q - move / sj
            ways.append((pi, pj, gap(pi, si, j + 1) + gap(pj, sj, j + 1), abs(move)))
        up, down = ways
        if abs(up[2] - down[2]) > 1e-6:
            p, q = min(ways, key=lambda w: w[2])[:2]
        else:
            p, q = (up if _draw(seed, *ids[i], *ids[j]) * (up[3] + down[3]) < down[3] else down)[:2]
        if q <= tiny or q >= 1 - tiny:
            taken[j] = int(q > 0.5)
            if p <= tiny or p >= 1 - tiny:
                taken[i] = int(p > 0.5)
                i = -1
        else:
            taken[i] = int(p > 0.5)
            i, p = j, q
    if i >= 0:
        if final:
            taken[i] = int(p > 0.5)
        else:
            left[i] = p
    return taken, left


def _node(seed: int, final: bool):
    columns = [c.split()[0] for c in _ROWS.split(", ")]

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "doc_id", "r1", "r2", "occ"], ascending=[False, True, True, True, True], kind="stable")
        keys = list(block[["r1", "r2", "occ"]].itertuples(index=False, name=None))
        taken, left = settle(keys, block["size"].tolist(), block["frac"].tolist(), seed, final)
        block["copies"] += taken
        block["frac"] = [x if x >= 0 else None for x in left]
        return block[columns]

    return run


def _row_keys(docs: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of all of a row's values."""
    values = [F.to_json(F.struct(docs[f"`{n}`"])) if "map<" in t or t == "variant" else docs[f"`{n}`"] for n, t in docs.dtypes]
    return F.xxhash64(*values), F.xxhash64(F.lit(1), *values)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, seed: int = 20) -> DataFrame:
    """One row per document: ``doc_id, r1, r2, source, size, source_size, target, copies, taken``.

    ``r1`` and ``r2`` are hashes of all the row's values.
    """
    r1, r2 = _row_keys(docs)
    sized = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        r1.alias("r1"),
        r2.alias("r2"),
        docs[source_col].cast("string").alias("source"),
        F.regexp_count(F.coalesce(docs[text_col].cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
    )
    sized = stored(sized.groupBy("doc_id", "r1", "r2", "source", "size").agg(F.count(F.lit(1)).alias("m")), "mix-sizes")
    targets = stored(source_targets(sized.withColumn("size", F.col("size") * F.col("m")), weights, share), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    same = sized["source"].eqNullSafe(targets["source"])
    shares = sized.join(targets.select("source", "docs", rate.alias("rate")), same).drop(targets["source"])
    whole = F.floor("rate")
    runs = shares.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / RUN))))
    first = F.col("run") * RUN
    shares = runs.withColumn("occ", F.explode(F.sequence(first, F.least(first + RUN, F.col("m")) - 1))).select(
        "doc_id", "r1", "r2", "occ", "source", "size",
        F.pmod(F.xxhash64(F.lit(seed), "r1", "occ"), F.ceil(F.col("docs") / BLOCK)).alias("salt"),
        whole.alias("copies"),
        F.when(F.col("size") > 0, F.col("rate") - whole).otherwise(F.lit(0.0)).alias("frac"),
    )
    most = targets.agg(F.max("docs")).first()[0] or 0
    level = stored(shares.groupBy("source", "salt").applyInPandas(_node(seed, False), _ROWS), "mix-leaves")
    out, nodes, step = level.filter("frac is null"), -(-most // BLOCK), 1
    while True:
        final = nodes <= FAN_IN
        rest = level.filter("frac is not null").withColumn("salt", F.floor(F.col("salt") / FAN_IN))
        level = rest.groupBy("source", "salt").applyInPandas(_node(seed + step, final), _ROWS)
        if final:
            out = out.unionByName(level)
            break
        level = stored(level, "mix-nodes")
        out, nodes, step = out.unionByName(level.filter("frac is null")), -(-nodes // FAN_IN), step + 1
    same = out["source"].eqNullSafe(targets["source"])
    return out.join(targets, same).select("doc_id", "r1", "r2", out["source"], "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as many times as it has copies, with its own columns."""
    r1, r2 = _row_keys(docs)
    copies = mix(docs, **options).groupBy("r1", "r2").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    once = F.row_number().over(Window.partitionBy("r1", "r2").orderBy(F.lit(1)))  # equal rows: any stands for all
    own = docs.select(r1.alias("r1"), r2.alias("r2"), F.struct("*").alias("row")).withColumn("once", once).filter("once = 1")
    return own.join(copies, ["r1", "r2"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
