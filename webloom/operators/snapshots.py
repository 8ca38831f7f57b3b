"""Ordered page snapshots: concatenation, accumulation, convergence and cut-offs
(A10, A11, W3, W4, W5, W8, O3, H15, F12).

Snapshots are rows ``(key, step, ...)``: the states one page went through (scrolls,
clicks, next pages). Step numbers and previous states come from the ordered scan in
``webloom.operators.scan`` (a key may hold a third of all rows, so no per-key
window); cut-offs are grouped minima joined back; concatenation is bucketed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.operators.scan import keyed_running, keyed_scan

# states per partial string when concatenating one key's states: a hot key is split
# into buckets of this many steps, concatenated in parallel, then joined in order
CONCAT_BUCKET = 1024
# characters of one chunk of a concatenation in long form
ROPE_CHARS = 1 << 20


def ordered_concat(df: DataFrame, key: str, order: list[str], text: str, sep: str = "\n",
                   bucket: int = CONCAT_BUCKET) -> DataFrame:
    """A10: ``(key, n_states, text)`` = states joined with ``sep`` in step order.

    ``order[0]`` is the integral step. Two levels: (key, step bucket) partial
    strings first, so a hot key is sorted by many tasks at most ``bucket`` steps
    each, then the partials of a key in bucket order. No per-key window. The output
    value is the whole group by definition.
    """
    o = [F.col(c) for c in order]
    d = df.select(key, *o, F.col(text)).withColumn("_b", F.floor(o[0] / bucket))
    part = d.groupBy(key, "_b").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*o, F.col(text).alias("_t")))),
                                 lambda x: x["_t"]), sep).alias("_s"),
        F.count("*").alias("_c"))
    return part.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_s"))), lambda x: x["_s"]), sep).alias(text),
        F.sum("_c").alias("n_states"))


def accumulate(df: DataFrame, key: str, order: list[str], target_of: Column, text: str,
               targets: list[str], sep: str = "\n") -> DataFrame:
    """A11+F12: per key and configured target, the texts of every state appended in
    step order; every target is pre-seeded, so targets without texts are empty (and
    the key is kept, since the map is non-empty as a map).

    Returns ``(key, target, n_items, text)``; the seed is a per-row explode of the
    configured target list (no join, no cross product).
    """
    keys = df.select(key).distinct()
    seeded = keys.select(key, F.explode(F.array(*[F.lit(t) for t in targets])).alias("target"))
    items = df.select(key, *order, target_of.alias("target"), F.col(text)).filter(F.col("target").isin(targets))
    cat = ordered_concat(items.withColumn("_k", F.struct(key, "target")), "_k", order, text, sep)
    cat = cat.select(F.col("_k")[key].alias(key), F.col("_k.target").alias("target"), text, "n_states")
    out = seeded.join(cat, [key, "target"], "left")
    return out.select(key, "target", F.coalesce("n_states", F.lit(0)).cast("bigint").alias("n_items"),
                      F.coalesce(text, F.lit("")).alias(text))


def rope(df: DataFrame, key: list[str], order: list[str], text: str, sep: str = "\n", chunk_chars: int = ROPE_CHARS) -> DataFrame:
    """A10/A11 in long form: ``(*key, chunk, offset, n_states, text)``, the concatenation of a key cut into ordered chunks.

    Running offsets place every state in the joined string; a chunk holds the states that start in its ``chunk_chars``
    characters, so it is as long as that and one state at most, and no task or row holds a whole key. The chunks of a key,
    put together in order, are its ``ordered_concat``. States without text are left out.
    """
    d = df.select(*key, *order, F.col(text).alias("_t")).where("_t is not null")
    d = d.withColumn("_len", F.char_length("_t") + F.lit(len(sep)))
    d = keyed_running(d, key, order, {"_end": "_len"})
    d = d.withColumn("_start", F.col("_end") - F.col("_len")).withColumn("chunk", F.floor(F.col("_start") / chunk_chars))
    states = F.array_sort(F.collect_list(F.struct("_start", *order, "_t")))
    g = d.groupBy(*key, "chunk").agg(F.min("_start").alias("_start"), F.count("*").alias("n_states"), states.alias("_l"))
    # a chunk brings the separator in front of its first state, which the first chunk of a key does not have
    body = F.array_join(F.transform("_l", lambda x: x["_t"]), sep)
    later = F.col("_start") > 0
    return g.select(*key, "chunk", F.when(later, F.col("_start") - len(sep)).otherwise(F.lit(0)).cast("bigint").alias("offset"), "n_states",
                    F.when(later, F.concat(F.lit(sep), body)).otherwise(body).alias("text"))


def rope_digest(chunks: DataFrame, key: list[str]) -> DataFrame:
    """``(*key, n_states, n_chars, n_chunks, digest)``: the digests of the chunks with their offsets, summed.

    A sum is folded in every task before the shuffle, and the offsets make it depend on the order of the chunks.
    """
    part = F.conv(F.substring(F.md5(F.concat(F.col("offset").cast("string"), F.lit(":"), "text")), 1, 12), 16, 10).cast("bigint")
    return chunks.groupBy(*key).agg(
        F.sum("n_states").cast("bigint").alias("n_states"), F.sum(F.char_length("text")).cast("bigint").alias("n_chars"),
        F.count("*").cast("bigint").alias("n_chunks"), F.sum(part.cast("decimal(38,0)")).cast("string").alias("digest"))


def accumulate_rope(df: DataFrame, key: str, order: list[str], target_of: Column, text: str, targets: list[str],
                    sep: str = "\n", chunk_chars: int = ROPE_CHARS) -> DataFrame:
    """A11+F12 in long form: ``(key, target, chunk, offset, n_states, text)``; a target without texts has one empty chunk."""
    items = df.select(key, *order, target_of.alias("target"), F.col(text)).where(F.col("target").isin(targets))
    chunks = rope(items, [key, "target"], order, text, sep, chunk_chars)
    seeded = df.select(key).distinct().select(key, F.explode(F.array(*[F.lit(t) for t in targets])).alias("target"))
    none = seeded.join(items.where(F.col(text).isNotNull()).select(key, "target").distinct(), [key, "target"], "left_anti")
    return chunks.unionByName(none.select(key, "target", *[F.lit(0).cast("bigint").alias(c) for c in ("chunk", "offset", "n_states")],
                                          F.lit("").alias("text")))


def step_number(df: DataFrame, key: str, order: list[str], name: str = "step") -> DataFrame:
    """1-based step per key in ``order`` (ordered scan: hot keys are split)."""
    return keyed_scan(df, [key], order, step_col=name)


def _keep_until_first(d: DataFrame, key: str, flag: Column) -> DataFrame:
    """Keep steps up to (and including) the first flagged step of each key.

    The first flagged step is a grouped min (partial aggregation, hot keys reduced
    map-side); joining it back is a one-row-per-key join (AQE splits a hot key)."""
    stop = d.filter(flag).groupBy(key).agg(F.min("step").alias("_stop"))
    j = d.join(stop, key, "left")
    return j.filter(F.col("_stop").isNull() | (F.col("step") <= F.col("_stop"))).drop("_stop")


def converged(df: DataFrame, key: str, order: list[str], measure: str) -> DataFrame:
    """Keep states up to the first one whose measure equals the previous state's
    (the measured height stopped changing); keys that never converge keep everything."""
    d = keyed_scan(df, [key], order, [measure])
    return _keep_until_first(d, key, F.col(measure) == F.col("prev_" + measure)).drop("prev_" + measure)


def page_cap(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The initial state plus ``n - 1`` next pages per key."""
    return step_number(df, key, order).filter(F.col("step") <= n)


def marker_parts(marker, sep: str = "/") -> tuple[Column, Column]:
    """``cur<sep>total`` split (separator taken literally)."""
    parts = F.split(F.col(marker) if isinstance(marker, str) else marker, _regex_quote(sep))
    return parts[0], parts[1]


def _regex_quote(s: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in s)


def progress_cut(df: DataFrame, key: str, order: list[str], marker: str, sep: str = "/",
                 as_text: bool = False) -> DataFrame:
    """Keep states until the one whose marker says cur >= total (inclusive).

    Numbers are compared as integers; ``as_text=True`` compares the strings (so
    "10" < "9"), the as-written behaviour.
    """
    cur, total = marker_parts(marker, sep)
    if as_text:
        done = cur >= total
    else:
        done = cur.try_cast("bigint") >= total.try_cast("bigint")
    d = step_number(df.withColumn("_done", F.coalesce(done, F.lit(False))), key, order, "_step")
    d = d.withColumnRenamed("_step", "step") if "step" not in df.columns else d.withColumn("step", F.col("_step"))
    out = _keep_until_first(d, key, F.col("_done")).drop("_done")
    return out.drop("_step") if "step" in df.columns else out.drop("step")


def drop_unchanged(df: DataFrame, key: str, order: list[str], state: str) -> DataFrame:
    """Drop a state equal (null-safe) to the previous state of the same key."""
    d = keyed_scan(df, [key], order, [state], step_col="_step")
    p = "prev_" + state
    return d.filter((F.col("_step") == 1) | ~F.col(state).eqNullSafe(F.col(p))).drop(p, "_step")
