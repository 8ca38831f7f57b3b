"""Ordered scan per key without a per-key window (hot keys split across tasks).

``row_number() over (partition by key order by ...)`` puts every row of a key into
one task. When one key may hold a third of the data, that task is the job. Here:

1. range-partition on ``(key, order)``: the sampled range bounds split a hot key
   over many partitions; the partition id is fixed by a reliable checkpoint;
2. a per-partition boundary summary (first / last key, their row counts, the last
   row's values: at most two rows per partition, never per key or per row) gives
   each partition the step offset and previous-row values it continues from;
3. windows over ``(partition, key)``, each bounded by one partition's rows, plus
   those carries give the exact per-key step number and previous values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.operators.common import cut_lineage


def _ranged(df: DataFrame, key: list[str], order: list[str], partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows in ranges of (key, order), with _key and _pid fixed by a checkpoint; and those of each range's first and last key."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kcol = F.to_json(F.struct(*[F.col(k) for k in key]))
    d = df.withColumn("_key", kcol).repartitionByRange(n, "_key", *order).sortWithinPartitions("_key", *order)
    d = cut_lineage(d.withColumn("_pid", F.spark_partition_id()))
    bounds = d.groupBy("_pid").agg(F.min("_key").alias("_kmin"), F.max("_key").alias("_kmax"))
    return d, d.join(F.broadcast(bounds), "_pid").filter((F.col("_key") == F.col("_kmin")) | (F.col("_key") == F.col("_kmax")))


def keyed_running(df: DataFrame, key: list[str], order: list[str], sums: dict[str, str] | None = None,
                  maxes: dict[str, str] | None = None, partitions: int | None = None) -> DataFrame:
    """Running sums and maxima per key in ``order``, the row itself included: ``{result column: input column}`` of integers.

    The carries of a partition are its first key's totals in the partitions before it, so no key is held by one task.
    """
    sums, maxes = sums or {}, maxes or {}
    d, edge = _ranged(df, key, order, partitions)
    totals = [F.sum(c).cast("bigint").alias(o) for o, c in sums.items()] + [F.max(c).cast("bigint").alias(o) for o, c in maxes.items()]
    rows = edge.groupBy("_pid", "_key", "_kmin", "_kmax").agg(*totals).collect()  # <= 2 rows per partition
    by_pid: dict[int, dict[str, object]] = {}
    for r in rows:
        by_pid.setdefault(r["_pid"], {"first": r["_kmin"], "last": r["_kmax"]})[r["_key"]] = r
    carries, open_key, carry = [], None, {}
    add = {**{o: lambda a, b: (a or 0) + (b or 0) for o in sums},
           **{o: lambda a, b: max((x for x in (a, b) if x is not None), default=None) for o in maxes}}
    for pid in sorted(by_pid):
        e = by_pid[pid]
        before = carry if e["first"] == open_key else dict.fromkeys(add)
        carries.append((pid, e["first"], *[before[o] for o in add]))
        own = {o: e[e["last"]][o] for o in add}
        carry = {o: add[o](before[o], own[o]) for o in add} if e["first"] == e["last"] else own
        open_key = e["last"]
    schema = "_pid int, _key string" + "".join(f", _c_{o} bigint" for o in add)
    d = d.join(F.broadcast(df.sparkSession.createDataFrame(carries, schema)), ["_pid", "_key"], "left")
    w = Window.partitionBy("_pid", "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for o, c in sums.items():
        d = d.withColumn(o, (F.coalesce(F.col(f"_c_{o}"), F.lit(0)) + F.coalesce(F.sum(c).over(w), F.lit(0))).cast("bigint"))
    for o, c in maxes.items():
        d = d.withColumn(o, F.greatest(F.col(f"_c_{o}"), F.max(c).over(w)).cast("bigint"))
    return d.drop("_pid", "_key", *[f"_c_{o}" for o in add])


def keyed_scan(df: DataFrame, key: list[str], order: list[str], lag_cols: list[str] | None = None,
               partitions: int | None = None, step_col: str = "step") -> DataFrame:
    """Adds ``step`` (1-based position within the key in ``order``) and
    ``prev_<c>`` (value of ``c`` on the previous row of the same key, NULL first)."""
    lag_cols = lag_cols or []
    spark = df.sparkSession
    d, edge = _ranged(df, key, order, partitions)
    ordering = F.struct(*[F.col(c) for c in order])
    last_vals = F.struct(*[F.col(c) for c in lag_cols]) if lag_cols else F.lit(None)
    summary = (edge.groupBy("_pid", "_key", "_kmin", "_kmax")
               .agg(F.count("*").alias("_c"), F.max_by(last_vals, ordering).alias("_last"))
               .collect())  # <= 2 rows per partition

    per_pid: dict[int, dict] = {}
    for r in summary:
        e = per_pid.setdefault(r["_pid"], {"kmin": r["_kmin"], "kmax": r["_kmax"]})
        e["min" if r["_key"] == r["_kmin"] else "max"] = (r["_c"], r["_last"])
        if r["_kmin"] == r["_kmax"]:
            e["max"] = e["min"]
    carries = []
    cur_key, cur_count, cur_last = None, 0, None
    for pid in sorted(per_pid):
        e = per_pid[pid]
        cont = e["kmin"] == cur_key
        prev = cur_last if cont else None
        carries.append((pid, e["kmin"], cur_count if cont else 0,
                        *[(prev[c] if prev is not None else None) for c in lag_cols]))
        if e["kmin"] == e["kmax"]:
            cur_count = (cur_count if cont else 0) + e["min"][0]
        else:
            cur_count = e["max"][0]
        cur_key, cur_last = e["kmax"], e["max"][1]

    fields = [T.StructField("_pid", T.IntegerType()), T.StructField("_key", T.StringType()),
              T.StructField("_off", T.LongType())]
    fields += [T.StructField("_cp_" + c, df.schema[c].dataType) for c in lag_cols]
    carry_df = spark.createDataFrame(carries, T.StructType(fields))

    w = Window.partitionBy("_pid", "_key").orderBy(*order)
    out = d.withColumn("_rn", F.row_number().over(w))
    for c in lag_cols:
        out = out.withColumn("_lg_" + c, F.lag(c).over(w))
    out = out.join(F.broadcast(carry_df), ["_pid", "_key"], "left")
    out = out.withColumn(step_col, (F.col("_rn") + F.coalesce(F.col("_off"), F.lit(0))).cast("bigint"))
    for c in lag_cols:
        out = out.withColumn("prev_" + c, F.when(F.col("_rn") == 1, F.col("_cp_" + c)).otherwise(F.col("_lg_" + c)))
    drop = ["_key", "_pid", "_rn", "_off"] + [p + c for c in lag_cols for p in ("_lg_", "_cp_")]
    return out.drop(*drop)
