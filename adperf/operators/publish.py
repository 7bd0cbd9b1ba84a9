"""Gated publishing of predictions into a partitioned bid table (ops B28, C24, D29, I1, I2, A7).

The experiment group is a left join against the group table (not a driver
side set in a closure); the override and the reason record are native column
expressions (no Python UDF). A publish stages its rows, checks the count that
the staging write observed, and only then swaps them in.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adperf.operators.evaluate import composite_rpc
from adperf.operators.ordering import dedup_first
from adperf.session import drop_path, scratch_path
from adperf.sources.files import literal

PRED_KEY = ["ad_id", "is_mobile", "division"]


def prediction_side(preds: DataFrame) -> DataFrame:
    """rpc = convrt x ordersize, one row per prediction key (ops H5, F4)."""
    p = preds.select(*PRED_KEY, composite_rpc("pred_convrt", "pred_ordersize").alias("rpc"),
                     "pred_convrt", "pred_ordersize")
    return dedup_first(p, PRED_KEY, ["rpc", "pred_convrt", "pred_ordersize"])


def prediction_join(prod: DataFrame, preds: DataFrame) -> DataFrame:
    """Bid rows LEFT JOIN the de-duplicated predictions; row count unchanged (op C24)."""
    return prod.join(prediction_side(preds), PRED_KEY, "left")


def gate(groups: DataFrame | None, divisions: list[str] | None, super_depts: list[str] | None) -> Column:
    """Row is eligible: in the experiment group (if groups given) and in the lists (if given) (op I1)."""
    ok = F.lit(True)
    if groups is not None:
        ok = ok & F.col("_in_group")
    if divisions:
        ok = ok & F.col("division").isin(*divisions)
    if super_depts:
        ok = ok & F.col("super_dept").isin(*super_depts)
    return F.coalesce(ok, F.lit(False))


def reason_json(convrt: str | Column, ordersize: str | Column) -> Column:
    """``{"objective":"Experiment","convrt":..,"ordersize":..}`` (op B28)."""
    return F.to_json(F.struct(F.lit("Experiment").alias("objective"), F.col(convrt).alias("convrt")
                              if isinstance(convrt, str) else convrt.alias("convrt"),
                              F.col(ordersize).alias("ordersize") if isinstance(ordersize, str) else ordersize.alias("ordersize")))


def gated_override(prod: DataFrame, preds: DataFrame, groups: DataFrame | None = None,
                   divisions: list[str] | None = None, super_depts: list[str] | None = None) -> DataFrame:
    """Replace ``adjusted_rpc`` (and the reason) where eligible and the rpc is present and non-zero (ops I1, S17)."""
    j = prediction_join(prod, preds)
    if groups is not None:
        g = groups.where(F.col("grp") == "1").select(F.col("adid").alias("_gid")).distinct()
        j = j.join(g, F.col("ad_id") == F.col("_gid"), "left").withColumn("_in_group", F.col("_gid").isNotNull())
    apply = gate(groups, divisions, super_depts) & F.col("rpc").isNotNull() & (F.col("rpc") != 0)
    out = j.withColumns({
        "old_adjusted_rpc": F.col("adjusted_rpc"),
        "adjusted_rpc": F.when(apply, F.col("rpc")).otherwise(F.col("adjusted_rpc")),
        "adj_reason": F.when(apply, reason_json("pred_convrt", "pred_ordersize")).otherwise(F.col("adj_reason"))})
    return out.drop(*[c for c in ("_gid", "_in_group") if c in out.columns])


def modified_count(df: DataFrame, old: str = "old_adjusted_rpc", new: str = "adjusted_rpc") -> DataFrame:
    """Rows whose value changed, nulls compared safely (op D29, S17)."""
    return df.agg(F.count_if(~F.col(old).eqNullSafe(F.col(new))).alias("modified"), F.count(F.lit(1)).alias("rows"))


def publish_dynamic(df: DataFrame, path: str, partition_cols: list[str], expected_rows: DataFrame | None = None,
                    fmt: str = "parquet") -> dict:
    """Overwrite only the partitions present in ``df``, after its row count has been checked (ops A7, I2).

    The rows are first written to a staging table in the shared folder, which
    observes their count in the same job. If ``expected_rows`` is given and its
    count differs, nothing is published. Then the staged rows replace the
    partitions (``df`` may have read them), and the staging table goes.
    """
    spark = df.sparkSession
    staging, obs = scratch_path(spark, "publish"), Observation("publish")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(staging)
    got = obs.get
    try:
        if expected_rows is not None and (want := expected_rows.count()) != got["rows"]:
            raise ValueError(f"{got['rows']} rows to publish, expected {want}")
        (spark.read.schema(df.schema).parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_cols).format(fmt).save(path))
    finally:
        drop_path(spark, staging)
    return got


def _location(spark: SparkSession, table: str, spec: str = "") -> str:
    rows = spark.sql(f"describe table extended {table} {spec}")
    return rows.where("col_name = 'Location'").first()["data_type"]


def publish_table(df: DataFrame, table: str, static: dict, dynamic: list[str], expected_rows: DataFrame | None = None) -> dict:
    """Replaces partitions of a catalog table, each by one change of its location (ops A7, I2).

    ``static`` gives the values of some partition columns, the rows give those
    of ``dynamic``; only the partitions that the rows name are replaced. The new
    files are written beside the table, observed in the same job, and compared
    with ``expected_rows``; then the catalog points each partition to its new
    folder. A reader sees a partition's old files or its new ones, never a part,
    and ``df`` may read what it replaces. Rows without a value in a dynamic
    column or another count than expected are an error and change nothing. The
    old folders stay for readers that have begun; the result lists them
    (``replaced``) for the caller to delete. Without rows nothing changes.
    """
    spark = df.sparkSession
    fields = [f for f in spark.table(table).schema.fields if f.name not in static]
    fresh = f"{_location(spark, table).rstrip('/')}-published/{uuid.uuid4().hex}"
    obs = Observation("publish")
    missing = F.count_if(reduce(or_, [F.col(c).isNull() for c in dynamic], F.lit(False)))
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    rows.observe(obs, F.count(F.lit(1)).alias("rows"), missing.alias("missing")).write.partitionBy(*dynamic).parquet(fresh)
    got = obs.get
    want = got["rows"] if expected_rows is None else expected_rows.count()
    if got["missing"] or got["rows"] != want:
        drop_path(spark, fresh)
        raise ValueError(f"{got['rows']} rows to publish, {got['missing']} of them without a partition, expected {want}")
    replaced = []
    if got["rows"]:
        # Driver work is one row per partition, as many as the catalog itself is told of.
        encoded = F.regexp_replace("_metadata.file_path", "/[^/]+$", "")
        folder = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
        written = spark.read.schema(rows.schema).parquet(fresh)
        for part in written.select(*[F.col(c).cast("string") for c in dynamic], folder.alias("_folder")).distinct().collect():
            values = static | {c: part[c] for c in dynamic}
            spec = f"partition ({', '.join(f'{c} = {literal(v)}' for c, v in values.items())})"
            if spark.sql(f"show partitions {table} {spec}").isEmpty():
                spark.sql(f"alter table {table} add {spec} location {literal(part['_folder'])}")
            else:
                replaced.append(_location(spark, table, spec))
                spark.sql(f"alter table {table} {spec} set location {literal(part['_folder'])}")
    return {"rows": got["rows"], "replaced": replaced}
