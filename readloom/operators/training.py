"""Training-set jobs: scores, selection, sampling, splits, weights, quotas, fragments, models."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import match_length
from readloom.operators.ranks import with_place
from readloom.sources.shared import ensure_checkpoints

#: Modulus of the draws of ``fragment_slices``: products of two remainders fit in a long.
PRIME = 2_147_483_647
#: Leading hexadecimal digits of a hash that make a cell: 65,536 of them, of 1.5 million rows each in 100 billion.
DIGITS = 4


def hash_ranked(df: DataFrame, keys: list[str], id_col: str, seed: int, name: str) -> DataFrame:
    """Rank within ``keys`` in the order of a hash of id and seed: a random order that reruns and partitioning don't change.

    The leading hash digits cut each class into 65,536 cells.  Ranks are those
    within a cell plus the sizes of the cells before, so a class of a third of
    all rows is no one task's.
    """
    hashed = df.withColumn("_h", F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))).withColumn("_cell", F.substring("_h", 1, DIGITS))
    sizes = hashed.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_cell").alias("_c"), F.coalesce(ahead, F.lit(0)).alias("_before"))
    own = hashed.withColumn("_own", F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy("_h", id_col)))
    same = F.col("_cell") == F.col("_c")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    ranked = own.join(sizes, same).withColumn(name, F.col("_own") + F.col("_before"))
    return ranked.drop("_h", "_cell", "_own", "_before", "_c", *(f"_k{i}" for i in range(len(keys))))


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Position in a global order, without a single-partition sort: ranks within range partitions plus their offsets.

    The first order column must be a string of hexadecimal digits; its leading
    four give 65,536 ranges, whose sizes are all that is sent to every task.
    """
    ranged = df.withColumn("_range", F.substring(order[0], 1, DIGITS))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_own", own).join(F.broadcast(offsets), "_range").withColumn(name, F.col("_own") + F.col("_before")).drop("_range", "_own", "_n", "_before")


def reference_blacklist(matches: DataFrame, curated: DataFrame, least: int = 100) -> DataFrame:
    """Both names of all matches of ``least`` bases or more, and the curated names: distinct and sorted."""
    long = matches.filter((F.col("m_length") >= least) & (F.col("query") != F.col("target")))
    return long.select(F.col("query").alias("name")).union(long.select("target")).union(curated.select("name")).distinct().orderBy("name")


def control_mapq(hits: DataFrame) -> DataFrame:
    return hits.filter(F.col("flag").bitwiseAND(4) == 0).groupBy("read_id").agg(F.max("mapq").alias("mapq"))


def best_scores(hits: DataFrame) -> DataFrame:
    """Greatest matched length per read and sample over mapped rows."""
    mapped = hits.filter(F.col("flag").bitwiseAND(4) == 0)
    return mapped.groupBy("read_id", "sample").agg(F.max(match_length(F.col("cigar"))).alias("score"))


def score_matrix(scores: DataFrame, samples: list[str]) -> DataFrame:
    """One column per sample; missing scores are 0, negative ones too."""
    wide = scores.groupBy("read_id").pivot("sample", samples).agg(F.max("score")).na.fill(0)
    return wide.select("read_id", *(F.greatest(F.col(s), F.lit(0)).alias(s) for s in samples))


def drop_ambiguous(df: DataFrame, hits: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Leave out reads with any hit on a blacklisted reference."""
    bad = hits.join(blacklist, "ref", "left_semi").select("read_id").distinct()
    return df.join(bad, "read_id", "left_anti")


def best_and_second(matrix: DataFrame, samples: list[str]) -> DataFrame:
    """Best and second score, their ratio, and the best sample (ties: the first configured) with its index."""
    arr = F.array(*samples)
    down = F.array_sort(arr, lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0))
    out = matrix.withColumns({"best": F.array_max(arr), "second": F.element_at(down, 2)})
    index = (F.array_position(arr, F.col("best")) - 1).cast("long")
    return out.withColumns({"ratio": F.col("best") / (F.col("best") + F.col("second")), "sample_index": index, "sample": F.element_at(F.array(*map(F.lit, samples)), (index + 1).cast("int"))})


def select_reads(scores: DataFrame, adapters: DataFrame, summary: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Join scores, adapter positions and the summary, and keep reads within all limits, ordered by class and id."""
    j = scores.join(adapters, "read_id").join(summary, "read_id").withColumn("adapter_length", F.col("end") - F.col("start"))
    keep = (
        (F.col("adapter_length") >= limits["adapter_min"]) & (F.col("adapter_length") <= limits["adapter_max"])
        & (F.col("best") >= limits["best_min"]) & (F.col("second") <= limits["second_max"]) & (F.col("ratio") >= limits["ratio_min"])
        & (F.col("mean_qscore") >= limits["quality_min"]) & (F.col("sequence_length") >= limits["length_min"]) & (F.col("status") == "okay")
    )
    return j.filter(keep).orderBy("sample_index", "read_id")


def class_cap_sample(df: DataFrame, cap: int, seed: int = 922, label: str = "label", id_col: str = "read_id") -> DataFrame:
    """At most ``cap`` random rows of each class."""
    return hash_ranked(df, [label], id_col, seed, "_r").filter(F.col("_r") <= cap).drop("_r")


def stratified_split(df: DataFrame, share: float, seed: int = 923, label: str = "label", id_col: str = "read_id") -> DataFrame:
    """``is_test``: the floor of ``share`` of each class, chosen at random."""
    n = df.groupBy(F.col(label).alias("_label")).agg(F.floor(F.count(F.lit(1)) * share).alias("_n"))
    ranked = hash_ranked(df, [label], id_col, seed, "_r")
    return ranked.join(n, F.col(label).eqNullSafe(F.col("_label"))).withColumn("is_test", F.col("_r") <= F.col("_n")).drop("_r", "_n", "_label")


def with_decoys(df: DataFrame, decoys: DataFrame, label: str = "label", id_col: str = "read_id") -> DataFrame:
    """Real classes move up by one; decoys are class 0 under the all-zero id."""
    zero = F.lit("00000000-0000-0000-0000-000000000000")
    return df.withColumn(label, F.col(label) + 1).unionByName(decoys.withColumns({label: F.lit(0).cast("long"), id_col: zero}))


def shuffled(df: DataFrame, seed: int, id_col: str = "read_id") -> DataFrame:
    """``rank``: a random global order."""
    key = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))
    return global_rank(df, [key, F.col(id_col)])


def one_hot(label: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == label, 1.0).otherwise(0.0))


def class_weights(df: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """Balanced weights ``n / (classes * n_class)`` within each split."""
    per = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    return per.withColumn("weight", F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n")))


def length_histogram(df: DataFrame, low: int, high: int, bins: int, col: str = "pooled_length") -> DataFrame:
    """Counts in equal bins over ``[low, high]``, right end included; other lengths are ignored, empty bins have 0."""
    width = (high - low) / bins
    at = F.least(F.floor((F.col(col) - low) / width), F.lit(bins - 1))
    per = df.filter(F.col(col).between(low, high)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return spine.join(per, "bin", "left").select("bin", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def apportion(counts: DataFrame, total: int, key: str = "bin", col: str = "n") -> DataFrame:
    """Quotas that add up to ``total``: whole parts, and one more for the largest remainders."""
    share = F.col(col) * F.lit(total) / F.sum(col).over(Window.partitionBy())
    parts = counts.withColumn("_s", share).withColumn("_w", F.floor("_s").cast("long")).withColumn("_rest", F.round(F.col("_s") - F.col("_w"), 9))
    left = F.lit(total) - F.sum("_w").over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy(F.desc("_rest"), key))
    return parts.withColumns({"_left": left, "_rank": rank}).select(key, col, (F.col("_w") + F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0)).alias("quota"))


def fragment_slices(df: DataFrame, density: int, least: int, most: int, seed: int, signal: str = "signal") -> DataFrame:
    """Cut signals at drawn points (one in ``density`` on average) and keep fragments of fitting length: ``read_id, start, length, fragment``.

    Points are chosen inside the array, from a number of the read (28 bits of a
    hash of id and seed) and the place; cubes modulo a prime scatter
    neighbouring places.  Nothing is exploded but the fragments, and nothing is
    shuffled.  Both ends of a signal are cut points; a null signal is empty.
    """
    own = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("read_id").cast("string"), F.lit(str(seed)))), 1, 7), 16, 10).cast("long")
    whole = df.select("read_id", F.coalesce(F.col(signal), F.expr("array()")).alias("_x"), own.alias("_own"))
    size = F.size("_x").cast("long")

    def drawn(at: Column) -> Column:
        place = (F.col("_own") + at) % PRIME
        return ((place * place % PRIME) * place + at) % PRIME % density == 0

    cuts = whole.withColumn("_cuts", F.filter(F.sequence(F.lit(0).cast("long"), size), lambda at: (at == 0) | (at == size) | drawn(at)))
    spans = F.transform(F.slice("_cuts", 1, F.size("_cuts") - 1), lambda at, i: F.struct(at.alias("start"), (F.element_at("_cuts", i + 2) - at).alias("length")))
    fitting = F.filter(spans, lambda s: s["length"].between(least, most))
    return cuts.select("read_id", "_x", F.inline(fitting)).select("read_id", "start", "length", F.slice("_x", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("fragment"))


def next_at_least(left: DataFrame, right: DataFrame, keys: list[str], lkey: str, rkey: str, payload: list[str]) -> DataFrame:
    """Forward as-of join: for each left row the first right row of its keys whose ``rkey`` is ``lkey`` or more.

    Both sides are sorted together once, in ranges of keys and value, and the
    next right row is carried back; over the edges of a range by a table with
    the first right row of each key in each range.  So a key of a third of all
    rows is no one task's, and nothing is paired that doesn't match.  Null keys
    equal each other; a null value has no match.
    """
    ensure_checkpoints(left.sparkSession)
    columns = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.col(lkey).alias("_k"), F.lit(0).alias("_side"), F.struct(*columns).alias("_l"))
    b = right.filter(F.col(rkey).isNotNull()).select(*keys, F.col(rkey).alias("_k"), F.lit(1).alias("_side"), F.struct(F.col(rkey).alias("_rk"), *payload).alias("_r"))
    scatter = [f"_l.{c}" for c in columns if "map<" not in left.schema[c].dataType.simpleString()]  # deals equal left rows out
    order = [*keys, "_k", "_side", F.col("_r").asc_nulls_first(), *([F.xxhash64(*scatter)] if scatter else [])]
    placed = a.unionByName(b, allowMissingColumns=True).orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    within = F.first("_r", True).over(Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(Window.currentRow, Window.unboundedFollowing))
    heads = placed.groupBy("_part", *keys).agg(F.min_by("_r", F.when(F.col("_side") == 1, F.col("_at"))).alias("_head"))
    behind = F.first("_head", True).over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(1, Window.unboundedFollowing))
    edges = heads.select(F.col("_part").alias("_p"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)), behind.alias("_behind"))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    both = placed.withColumn("_own", within).filter("_side = 0").join(edges, same, "left")
    found = both.withColumn("_next", F.when(F.col("_k").isNotNull(), F.coalesce("_own", "_behind")))
    return found.select(*keys, "_l.*", *(F.col(f"_next.{c}").alias(f"next_{c}") for c in payload))


def quota_fill(candidates: DataFrame, quotas: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first candidates of each bin, as many as its quota.

    A rank is the place in one distributed sort less the first place of the
    bin, so a crowded bin is no one task's.
    """
    placed = with_place(candidates, key, *order, name="_r")
    starts = placed.groupBy(key).agg(F.min("_r").alias("_start"))
    bounds = starts.join(quotas.select(key, "quota"), key).select(key, (F.col("_start") + F.col("quota")).alias("_end"))
    return placed.join(bounds, key).filter(F.col("_r") < F.col("_end")).drop("_r", "_end")


def fit_demux(train: DataFrame, signal: str = "signal", label: str = "label", weight: str = "weight", max_iter: int = 20):
    """Multinomial classifier with class weights."""
    rows = train.select(array_to_vector(F.col(signal).cast("array<double>")).alias("features"), F.col(label).cast("double").alias("label"), F.col(weight).alias("weight"))
    return LogisticRegression(maxIter=max_iter, regParam=0.01, weightCol="weight").fit(rows)


def predict_demux(model, df: DataFrame, signal: str = "signal") -> DataFrame:
    return model.transform(df.withColumn("features", array_to_vector(F.col(signal).cast("array<double>")))).withColumn("probs", vector_to_array("probability")).drop("features", "rawPrediction", "probability", "prediction")


def prediction_table(df: DataFrame, label: str = "label", probs: str = "probs") -> DataFrame:
    """``read_id, prior_label, pred_label, pred_prob``."""
    best = F.array_max(probs)
    return df.select("read_id", F.col(label).alias("prior_label"), (F.array_position(probs, best) - 1).cast("long").alias("pred_label"), best.alias("pred_prob"))


def weighted_metrics(df: DataFrame, cost: DataFrame, probs: str = "probs") -> DataFrame:
    """Cross-entropy and accuracy with the weight ``cost[true, predicted]`` of each row."""
    best = (F.array_position(probs, F.array_max(probs)) - 1).cast("long")
    own = F.element_at(probs, (F.col("label") + 1).cast("int"))
    rows = df.withColumns({"predicted": best, "own": F.greatest(own, F.lit(1e-7))}).join(F.broadcast(cost), ["label", "predicted"])
    total = F.sum("weight")
    return rows.agg((F.sum(F.col("weight") * -F.log("own")) / total).alias("loss"), (F.sum(F.when(F.col("label") == F.col("predicted"), F.col("weight")).otherwise(0.0)) / total).alias("accuracy"))


def cost_matrix(spark, classes: int, confusion: float = 2.0) -> DataFrame:
    """``confusion`` between different real classes, else 1."""
    n = spark.range(classes)
    pairs = n.select(F.col("id").alias("label"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(classes - 1).cast("long"))).alias("predicted"))
    mixed = (F.col("label") != F.col("predicted")) & (F.col("label") > 0) & (F.col("predicted") > 0)
    return pairs.withColumn("weight", F.when(mixed, confusion).otherwise(1.0))
