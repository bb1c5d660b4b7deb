"""Domain tables derived from the generic test tables, in Spark and as DuckDB text for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per read."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) read_id",
        "concat('run', o_custkey % 4, '/part', o_orderkey % 50, '.parquet') filename",
        "concat('run', o_custkey % 4) run_id",
        "cast(o_custkey % 512 as string) channel",
        "case o_orderstatus when 'F' then 'pass' when 'O' then 'fail' else 'artifact' end label",
        """case o_orderstatus when 'F' then 'okay' when 'P' then 'unsplit_read' else
             case o_orderkey % 4 when 0 then 'sequence_too_short' when 1 then 'adapter_not_detected'
               when 2 then 'not_basecalled' else 'scaling_qc_fail' end end status""",
        "case when o_orderpriority like '5%' then null else cast(substr(o_orderpriority, 1, 1) as bigint) - 1 end barcode",
        "o_totalprice / 20000 mean_qscore",
        "200 + o_custkey % 7 * 60 sequence_length",
        "4000 + (o_custkey * 37) % 28000 adapter_length",
        "timestampdiff(second, timestamp_ntz'1970-01-01 00:00:00', cast(o_orderdate as timestamp_ntz)) % 1000000 start_time",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered events per read; ``start`` in samples."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) read_id",
        "cast(row_number() over (partition by user_id order by ts, event_id) as bigint) k",
        "100 + value * 0.2 mean",
        "1 + event_id % 120 length",
        "event_id % 3 move",
        "(value % 10) / 10 p_model_state",
        "value / 100 stdv",
        "event_type state",
    ).selectExpr("*", "sum(length) over (partition by read_id order by k) - length start")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array of samples per read."""
    return table(spark, sf_dir, "embeddings").selectExpr("cast(vec_id as string) read_id", "transform(embedding, x -> 90 + 40 * cast(x as double)) signal", "cast(label as bigint) label")


_LETTERS = "'abcdefghijklmnopqrstuvwxyz', 'ACGUACGUACGUACGUACGUACGUAC'"


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr("cast(doc_id as string) read_id", f"translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', ''), {_LETTERS}) seq")


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").selectExpr("concat('ref', item_id, '|x') name", f"translate(regexp_replace(lower(text), '[^a-z]', ''), {_LETTERS}) seq")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment rows."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) read_id",
        "l_partkey ref",
        "element_at(array('ath', 'hsa', 'sce', 'cel'), cast(1 + l_suppkey % 4 as int)) sample",
        "concat(cast(l_quantity as bigint) * 10, 'M', l_linenumber, 'I', cast(round(l_tax * 100) as bigint) * 10, 'M') cigar",
        "cast(round(l_discount * 600) as bigint) mapq",
        "case when l_returnflag = 'R' then 4 else 0 end flag",
        "cast(l_linenumber as bigint) line",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier output whose error rises as the score falls."""
    raw = table(spark, sf_dir, "lineitem").selectExpr("*", "cast(round(l_extendedprice * 100) as bigint) * 31 % 100003 h", "(cast(round(l_extendedprice * 100) as bigint) * 7919 % 1000003) / cast(1000003 as double) u")
    return raw.selectExpr(
        "concat(l_orderkey, '-', l_linenumber, '-', l_partkey) read_id",
        "l_suppkey % 5 prior_label",
        "case when h % 1000 < 2 + u * u * 600 then (l_suppkey + 1) % 5 else l_suppkey % 5 end pred_label",
        "1 - u * u * 0.8 pred_prob",
    )


def sampled_long(df: DataFrame, value: str = "signal") -> DataFrame:
    """Long form of an array column: ``read_id, i, x`` with i from 0."""
    return df.select("read_id", F.posexplode(value).alias("i", "x"))


_NT = "translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGUACGUACGUACGUACGUACGUAC')"

DUCK = {
    "v_reads": """select cast(o_orderkey as varchar) read_id, concat('run', o_custkey % 4, '/part', o_orderkey % 50, '.parquet') filename,
        concat('run', o_custkey % 4) run_id, cast(o_custkey % 512 as varchar) channel,
        case o_orderstatus when 'F' then 'pass' when 'O' then 'fail' else 'artifact' end as label,
        case o_orderstatus when 'F' then 'okay' when 'P' then 'unsplit_read' else
          case o_orderkey % 4 when 0 then 'sequence_too_short' when 1 then 'adapter_not_detected'
            when 2 then 'not_basecalled' else 'scaling_qc_fail' end end as status,
        case when o_orderpriority like '5%' then null else cast(substr(o_orderpriority, 1, 1) as bigint) - 1 end as barcode,
        o_totalprice / 20000 as mean_qscore, 200 + o_custkey % 7 * 60 as sequence_length,
        4000 + (o_custkey * 37) % 28000 as adapter_length, cast(epoch(o_orderdate) as bigint) % 1000000 as start_time from orders""",
    "v_evt": """select *, cast(sum(length) over (partition by read_id order by k) - length as bigint) as start from (
        select cast(user_id as varchar) read_id, row_number() over (partition by user_id order by ts, event_id) k,
        100 + value * 0.2 as mean, 1 + event_id % 120 as length, event_id % 3 as move, (value % 10) / 10 as p_model_state,
        value / 100 as stdv, event_type as state from events)""",
    "v_sig": "select cast(vec_id as varchar) read_id, list_transform(embedding, lambda x: 90 + 40 * cast(x as double)) signal, cast(label as bigint) as label from embeddings",
    "v_long": "select read_id, unnest(range(len(signal))) i, unnest(signal) x from v_sig",
    "v_seq": f"select cast(doc_id as varchar) read_id, {_NT} seq from documents",
    "v_refs": f"select concat('ref', item_id, '|x') as name, {_NT} seq from benchmark",
    "v_hits": """select cast(l_orderkey as varchar) read_id, l_partkey as ref, ['ath', 'hsa', 'sce', 'cel'][1 + (l_suppkey % 4)] as sample,
        concat(cast(l_quantity as bigint) * 10, 'M', l_linenumber, 'I', cast(round(l_tax * 100) as bigint) * 10, 'M') cigar,
        cast(round(l_discount * 600) as bigint) mapq, case when l_returnflag = 'R' then 4 else 0 end flag, cast(l_linenumber as bigint) line from lineitem""",
    "v_pred": """select concat(l_orderkey, '-', l_linenumber, '-', l_partkey) read_id, l_suppkey % 5 prior_label,
        case when h % 1000 < 2 + u * u * 600 then (l_suppkey + 1) % 5 else l_suppkey % 5 end pred_label, 1 - u * u * 0.8 pred_prob
        from (select *, cast(round(l_extendedprice * 100) as bigint) * 31 % 100003 h,
          (cast(round(l_extendedprice * 100) as bigint) * 7919 % 1000003) / cast(1000003 as double) u from lineitem)""",
}


def duck(sql: str) -> str:
    """An oracle text with the bindings it names put in front as common table expressions."""
    need: list[str] = []

    def add(text: str) -> None:
        for name, body in DUCK.items():
            if name in text and name not in need:
                add(body)
                need.append(name)

    add(sql)
    ctes = ", ".join(f"{n} as ({DUCK[n]})" for n in need)
    sql = sql.strip()
    if not ctes:
        return sql
    return f"with {ctes}, {sql[5:]}" if sql.lower().startswith("with ") else f"with {ctes} {sql}"
