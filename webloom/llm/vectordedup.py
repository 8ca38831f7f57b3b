"""Near-duplicate vectors by NN-descent: a neighbour graph refined through joins of neighbours of neighbours.

Two vectors are linked when their cosine in double precision is ``MIN_COSINE`` or more. Equal vectors are one class,
represented by its smallest id; the others of the class are linked with it and with each other by definition.

1. Start. Vectors are sorted by the signs of random projections, and runs of ``CHUNK`` neighbours in that order are
   compared; ``TREES`` such orders give every vector its first list of ``K`` neighbours. Runs are cut by position, so a
   large group of near copies fills many runs instead of one bucket.
2. Refinement. At every vector ``SAMPLE`` vectors of its list meet as many of those that list it, new entries first, with
   their own lists. Pairs there (neighbours and their neighbours) that do not list each other are compared, and the best
   finds go back to the lists. Who meets at a hub is limited by rank, which Spark applies before the shuffle. Rounds end
   when fewer than ``MIN_CHANGE`` of all entries are new; what a round leaves is written to the shared folder.
3. Threshold edges are the list entries whose cosine, computed again in double precision, reaches the threshold. Their
   components are found by star contraction.
4. Enlarged lists. A list is saturated when all its K entries reach the threshold: there may be more. Every component with
   such a vector is searched as a whole, without listing pairs: its members are dealt to balls around the nearest of
   a few of its members (pivots). Two balls whose centres and radii leave no doubt by the triangle inequality are linked
   or not linked as a whole and only counted; the members of the others are compared exactly, in tiles of two
   chunks. The pivots of different components go through the same descent with a threshold widened by
   the radii, so that saturated lists do not hide a neighbouring group.
5. Audit. The links of ``AUDIT`` vectors, chosen by hash, are counted against all rows. Below ``MIN_RECALL`` the lists
   are doubled and everything is done again; the last round's recall is returned.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; so do vectors of
different lengths with each other. Of rows that repeat an id the one with the smallest vector counts; rows with a null id
are returned with no links and a null component. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.components import components
from webloom.llm.hardnegatives import usable
from webloom.llm.tables import shared_path

MIN_COSINE = 0.9
K, SAMPLE, PER_MEETING = 16, 8, 6
TREES, CHUNK = 8, 128
MIN_CHANGE, MAX_ROUNDS = 0.05, 12
PIVOT_MEMBERS, TILE = 4096, 1024
AUDIT, MIN_RECALL, ATTEMPTS = 512, 0.95, 3
_LIST = "id long, x binary, nb array<bigint>, sim array<float>, fresh array<boolean>"


# -- vectors ------------------------------------------------------------------------------------------------------

def _unit(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of one length scaled to length one, in double precision; a scale first, so that squares neither vanish nor overflow."""
    x = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _units(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, u, x, d, code): unit vector in double and single precision, its length, and one projection code per tree."""
    for frame in frames:
        for dim, rows in frame.groupby(frame["v"].map(len), sort=False):
            u = _unit(rows["v"].tolist())
            planes = np.random.default_rng(dim).standard_normal((TREES * 32, dim))  # the same in every task
            bits = (u @ planes.T > 0).reshape(len(u), TREES, 32)
            codes = (bits * (1 << np.arange(31, -1, -1, dtype=np.int64))).sum(axis=2)
            yield pd.DataFrame({"id": rows["id"].to_numpy(), "u": [r.tobytes() for r in u], "x": [r.tobytes() for r in u.astype(np.float32)],
                                "d": dim, "code": list(codes)})


def _matrix(packed, dtype) -> np.ndarray:
    rows = list(packed)
    return np.frombuffer(b"".join(rows), dtype=dtype).reshape(len(rows), -1)


def _best_in(sims: np.ndarray, k: int) -> np.ndarray:
    """Per row the positions of its k largest values, largest first."""
    k = min(k, sims.shape[1])
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < sims.shape[1] else np.tile(np.arange(k), (len(sims), 1))
    return np.take_along_axis(at, np.argsort(-np.take_along_axis(sims, at, 1), axis=1, kind="stable"), 1)


# -- the neighbour graph --------------------------------------------------------------------------------------------

def _runs(k: int):
    """Sorted rows (id, x, d) to lists of candidates (id, ids, sims): the best of each run of CHUNK rows of one length."""
    def flush(ids, xs, d):
        if len(ids) < 2:
            return None
        x = _matrix(xs, np.float32)
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        best = _best_in(sims, min(k, len(ids) - 1))
        own = np.array(ids)
        return pd.DataFrame({"id": own, "ids": list(own[best]), "sims": list(np.take_along_axis(sims, best, 1))})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, xs, d = [], [], None
        for frame in frames:
            for i, x, dim in zip(frame["id"], frame["x"], frame["d"]):
                if dim != d or len(ids) == CHUNK:
                    if (out := flush(ids, xs, d)) is not None:
                        yield out
                    ids, xs, d = [], [], dim
                ids.append(i)
                xs.append(x)
        if (out := flush(ids, xs, d)) is not None:
            yield out

    return run


def _merge(k: int):
    """List entries and candidates (cand_ids, cand_sims, arrays of arrays) to the k best of both; new ones are fresh."""
    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            nb, sim, fresh = [], [], []
            for own, old_ids, old_sims, old_fresh, ids, sims in zip(f["id"], f["nb"], f["sim"], f["fresh"], f["cand_ids"], f["cand_sims"]):
                parts = [] if ids is None else [(np.asarray(a), np.asarray(b)) for a, b in zip(ids, sims)]
                all_ids = np.concatenate([old_ids, *(a for a, _ in parts)]).astype(np.int64)
                all_sims = np.concatenate([old_sims, *(b for _, b in parts)]).astype(np.float32)
                flags = np.r_[np.asarray(old_fresh, dtype=bool), np.ones(len(all_ids) - len(old_ids), dtype=bool)]
                _, first = np.unique(all_ids, return_index=True)  # an old entry stands before its repeats
                first = first[all_ids[first] != own]
                first = first[np.lexsort((all_ids[first], -all_sims[first]))][:k]
                nb.append(all_ids[first])
                sim.append(all_sims[first])
                fresh.append(flags[first])
            yield pd.DataFrame({"id": f["id"], "x": f["x"], "nb": nb, "sim": sim, "fresh": fresh})

    return merge


def _meetings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (at, id, x, nb, worst, fresh), sorted by at, to the best finds (id, ids, sims) of everyone who meets there."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = frame["at"].iloc[-1] if len(frame) else None
        open_ = (frame["at"] == last).to_numpy()
        rest = frame[open_]
        yield from _meet(frame[~open_])
    if rest is not None:
        yield from _meet(rest)


def _meet(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Meetings of equal size are compared together, in slices of bounded memory."""
    if not len(frame):
        return
    at = frame["at"].to_numpy()
    starts = np.r_[0, np.nonzero(np.diff(at))[0] + 1]
    sizes = np.diff(np.r_[starts, len(at)])
    ids, worst, fresh = frame["id"].to_numpy(), frame["worst"].to_numpy(dtype=np.float32), frame["fresh"].to_numpy(dtype=bool)
    x = frame["x"].to_numpy()
    width = int(frame["nb"].map(len).max())
    known = np.empty((len(frame), width), dtype=np.int64)  # short lists are filled up with the vector itself
    for i, nb in enumerate(frame["nb"]):
        known[i, :len(nb)] = nb
        known[i, len(nb):] = ids[i]
    for n in np.unique(sizes[sizes > 1]):
        of_size = starts[sizes == n]
        step = max(1, 200_000 // (n * n))
        for k in range(0, len(of_size), step):
            at_ = of_size[k:k + step, None] + np.arange(n)
            v = _matrix(x[at_.ravel()], np.float32).reshape(len(at_), n, -1)
            sims = v @ v.transpose(0, 2, 1)
            who = ids[at_]
            new = fresh[at_]
            # a pair of old entries has met before; who is listed already is no find
            useful = (new[:, :, None] | new[:, None, :]) & (sims > worst[at_][:, :, None]) & (who[:, :, None] != who[:, None, :])
            for j in range(width):
                useful &= known[at_, j][:, :, None] != who[:, None, :]
            sims = np.where(useful, sims, -2).reshape(-1, n)
            best = _best_in(sims, PER_MEETING)
            values = np.take_along_axis(sims, best, 1)
            found = values > -2
            some = found.any(axis=1)
            if some.any():
                others = np.repeat(who, n, axis=0)
                names = np.take_along_axis(others, best, 1)
                yield pd.DataFrame({"id": who.ravel()[some], "ids": [a[m] for a, m in zip(names[some], found[some])],
                                    "sims": [a[m] for a, m in zip(values[some], found[some])]})


def _merged(lists: DataFrame, finds: DataFrame, k: int) -> DataFrame:
    cand = finds.groupBy("id").agg(F.collect_list("ids").alias("cand_ids"), F.collect_list("sims").alias("cand_sims"))
    return lists.join(cand.hint("merge"), "id", "left").select("id", "x", "nb", "sim", "fresh", "cand_ids", "cand_sims").mapInPandas(_merge(k), _LIST)


def neighbour_graph(vectors: DataFrame, path: str, k: int = K) -> DataFrame:
    """(id, x, nb, sim, fresh): every vector of (id, x, d, code) with its k nearest found, best first."""
    spark = vectors.sparkSession
    trees = []
    for t in range(TREES):
        order = vectors.select("id", "x", "d", F.get("code", F.lit(t)).alias("c")).repartitionByRange("d", "c", "id")
        trees.append(order.sortWithinPartitions("d", "c", "id").select("id", "x", "d").mapInPandas(_runs(k), "id long, ids array<bigint>, sims array<float>"))
    empty = vectors.select("id", "x", F.lit(None).cast("array<bigint>").alias("nb"))
    lists = empty.select("id", "x", F.array().cast("array<bigint>").alias("nb"), F.array().cast("array<float>").alias("sim"),
                         F.array().cast("array<boolean>").alias("fresh"))
    _merged(lists, reduce(DataFrame.unionAll, trees), k).write.parquet(f"{path}/0")
    for r in range(1, MAX_ROUNDS + 1):
        lists = spark.read.parquet(f"{path}/{r - 1}")
        seen = lists.agg(F.sum(F.size("nb")).alias("n"), F.sum(F.size(F.filter("fresh", lambda b: b))).alias("new")).first()
        if not seen["new"] or seen["new"] < MIN_CHANGE * seen["n"]:
            return lists
        # the entries that take part: new ones first, then the best; a list's order is best first
        entry = F.transform("nb", lambda n, i: F.struct((~F.get("fresh", i)).alias("old"), i.alias("at"), n.alias("nb")))
        chosen = F.when(F.size("nb") > 0, F.slice(F.array_sort(entry), 1, SAMPLE))
        picked = lists.select("id", F.explode(chosen).alias("e")).select("id", F.col("e.nb").alias("nb"), (~F.col("e.old")).alias("fresh"))
        lucky = Window.partitionBy("nb").orderBy(F.desc("fresh"), F.xxhash64("id", F.lit(r)), "id")
        listed = picked.withColumn("rank", F.row_number().over(lucky)).where(F.col("rank") <= SAMPLE)
        # at a vector meet those that it lists, those that list it, and itself; a hub's row is joined with its many places
        goes = (picked.select(F.col("nb").alias("id"), F.col("id").alias("at"), "fresh")
                .unionByName(listed.select("id", F.col("nb").alias("at"), "fresh"))
                .unionByName(lists.select("id", F.col("id").alias("at"), F.lit(False).alias("fresh")))
                .groupBy("id", "at").agg(F.max("fresh").alias("fresh")))
        worst = F.when(F.size("nb") < k, F.lit(-2.0).cast("float")).otherwise(F.get("sim", F.lit(k - 1)))
        sent = goes.join(lists.select("id", "x", "nb", worst.alias("worst")).hint("merge"), "id").select("at", "id", "x", "nb", "worst", "fresh")
        finds = sent.repartition("at").sortWithinPartitions("at").mapInPandas(_meetings, "id long, ids array<bigint>, sims array<float>")
        # what took part is old from now on
        used = F.transform(F.filter(F.slice(F.array_sort(entry), 1, SAMPLE), lambda e: ~e["old"]), lambda e: e["nb"])
        still = F.zip_with("nb", "fresh", lambda i, b: b & ~F.array_contains(used, i))
        aged = lists.select("id", "x", "nb", "sim", F.when(F.size("nb") > 0, still).otherwise(F.col("fresh")).alias("fresh"))
        _merged(aged, finds, k).write.parquet(f"{path}/{r}")
    return spark.read.parquet(f"{path}/{MAX_ROUNDS}")


# -- links ------------------------------------------------------------------------------------------------------------

def _cosines(a: str, b: str, out: str, schema: str):
    """A function for mapInPandas: the cosine of the unit vectors in columns a and b, as column out in their place."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            values = np.zeros(len(f))
            for dim, rows in f.groupby(f[a].map(len), sort=False):
                values[f.index.get_indexer(rows.index)] = (_matrix(rows[a], np.float64) * _matrix(rows[b], np.float64)).sum(axis=1)
            yield f.drop(columns=[a, b]).assign(**{out: values})

    return run, schema


def _with_cosine(pairs: DataFrame, vectors: DataFrame, schema: str) -> DataFrame:
    """``pairs`` (a, b, ...) with the double-precision cosine; pairs of different lengths are left out."""
    left = vectors.select(F.col("id").alias("a"), F.col("u").alias("ua"))
    right = vectors.select(F.col("id").alias("b"), F.col("u").alias("ub"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where("octet_length(ua) = octet_length(ub)")
    run, out = _cosines("ua", "ub", "cosine", schema + ", cosine double")
    return both.mapInPandas(run, out)


def _angle(cosine):
    return F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))


def _nearest_pivot(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members (comp, id, u, pivots) to (comp, id, u, ball, angle): the pivot at the smallest angle."""
    for f in frames:
        parts = []
        for comp, rows in f.groupby("comp", sort=False):
            pivots = sorted(rows["pivots"].iloc[0], key=lambda p: p["id"])
            cos = _matrix(rows["u"], np.float64) @ _matrix([p["u"] for p in pivots], np.float64).T
            best = cos.argmax(axis=1)
            parts.append(rows[["comp", "id", "u"]].assign(
                ball=np.array([p["id"] for p in pivots], dtype=np.int64)[best],
                angle=np.arccos(np.clip(cos[np.arange(len(rows)), best], -1, 1))))
        if parts:
            yield pd.concat(parts, ignore_index=True)


def _tiles(min_cosine: float):
    """Tiles (a, b, rows, same): members with weights of two chunks to (id, links, a, b) of both sides."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for a, b, rows, same in zip(f["a"], f["b"], f["rows"], f["same"]):
                left = [r for r in rows if r["side"] == 0]
                right = left if same else [r for r in rows if r["side"] == 1]
                if not left or not right:
                    continue
                near = _matrix([r["u"] for r in left], np.float64) @ _matrix([r["u"] for r in right], np.float64).T >= min_cosine
                weight = [np.array([r["weight"] for r in side], dtype=np.int64) for side in (left, right)]
                if same:
                    np.fill_diagonal(near, False)
                    out.append(pd.DataFrame({"id": [r["id"] for r in left], "links": near @ weight[1], "a": a, "b": b}))
                else:
                    out.append(pd.DataFrame({"id": [r["id"] for r in left] + [r["id"] for r in right],
                                             "links": np.concatenate([near @ weight[1], near.T @ weight[0]]), "a": a, "b": b}))
            if out:
                done = pd.concat(out, ignore_index=True)
                yield done[done["links"] > 0]

    return run


def _codes_of(vectors: DataFrame) -> DataFrame:
    return vectors.select("id", "x", "d", "code")


def dense_links(vectors: DataFrame, member: DataFrame, min_cosine: float, path: str, k: int) -> tuple[DataFrame, DataFrame]:
    """All links inside the components of ``member`` (comp, id, size), and between components whose balls meet.

    Returns (id, links), the weights of the linked classes summed, and (a, b), one edge per pair of linked balls
    of different components. ``vectors`` has id, u, x, d, code and weight.
    """
    spark = vectors.sparkSession
    limit = math.acos(min_cosine)
    slack = 1e-7  # far above the rounding error of an angle, whatever the vectors' length
    rows = member.join(vectors.select("id", "u", "weight").hint("merge"), "id")
    rows.write.parquet(f"{path}/members")
    rows = spark.read.parquet(f"{path}/members")
    # one pivot for about PIVOT_MEMBERS members, chosen by hash, and the smallest id
    every = F.lit(PIVOT_MEMBERS)
    pivots = rows.where((F.col("id") == F.col("comp")) | (F.pmod(F.xxhash64("id"), every) == 0))
    pivots = pivots.groupBy("comp").agg(F.collect_list(F.struct("id", "u")).alias("pivots"))
    near = rows.select("comp", "id", "u").join(pivots.hint("merge"), "comp").mapInPandas(
        _nearest_pivot, "comp long, id long, u binary, ball long, angle double")
    near.join(rows.select("id", "weight").hint("merge"), "id").write.parquet(f"{path}/balls")
    dealt = spark.read.parquet(f"{path}/balls")
    balls = dealt.groupBy("comp", "ball").agg(F.max("angle").alias("radius"), F.sum("weight").alias("weight"), F.count("*").alias("size"))
    balls.write.parquet(f"{path}/ball-sizes")
    balls = spark.read.parquet(f"{path}/ball-sizes")
    # ball pairs: inside a component all, between components those that a descent over the pivots finds
    a = balls.select("comp", F.col("ball").alias("a"))
    inside = a.join(balls.select("comp", F.col("ball").alias("b")).hint("merge"), "comp").where("a <= b").select("a", "b")
    graph = neighbour_graph(_codes_of(vectors.join(balls.select(F.col("ball").alias("id")).hint("merge"), "id", "left_semi")), f"{path}/pivots", k)
    across = graph.select(F.col("id").alias("i"), F.explode("nb").alias("j")).select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
    pairs = _with_cosine(inside.unionByName(across).distinct(), vectors, "a long, b long")
    stats = balls.select("ball", "comp", "radius", "size", "weight")
    for side in ("a", "b"):
        pairs = pairs.join(stats.toDF(side, f"comp_{side}", f"radius_{side}", f"size_{side}", f"weight_{side}").hint("merge"), side)
    middle = F.when(F.col("a") == F.col("b"), 0.0).otherwise(_angle(F.col("cosine")))
    reach = F.col("radius_a") + F.col("radius_b")
    pairs = pairs.withColumn("all", middle + reach <= limit - slack).withColumn("open", ~F.col("all") & (middle - reach <= limit + slack))
    pairs.where(F.col("all") | F.col("open")).write.parquet(f"{path}/ball-pairs")
    pairs = spark.read.parquet(f"{path}/ball-pairs")
    whole = pairs.where("all")
    whole = whole.select(F.col("a").alias("ball"), F.col("weight_b").alias("links")).unionByName(
        whole.where("a != b").select(F.col("b").alias("ball"), F.col("weight_a").alias("links")))
    sums = whole.groupBy("ball").agg(F.sum("links").alias("links"))
    own = pairs.where("all and a = b").select(F.col("a").alias("ball"), F.lit(1).alias("self"))
    sure = dealt.select("id", "ball", "weight").join(sums.hint("merge"), "ball").join(own.hint("merge"), "ball", "left")
    # a member is in its own ball, but not linked with itself
    sure = sure.select("id", (F.col("links") - F.when(F.col("self").isNotNull(), F.col("weight")).otherwise(0)).alias("links"))
    open_ = pairs.where("open")
    chunks = lambda size: F.ceil(F.col(size) / TILE).cast("int")
    tiles = open_.select("a", "b", chunks("size_a").alias("na"), chunks("size_b").alias("nb"))
    tiles = tiles.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    tiles = tiles.where("a != b or i <= j")
    members = dealt.join(balls.select("ball", "size").hint("merge"), "ball").select(
        "ball", "id", "u", "weight", F.pmod(F.xxhash64("id"), chunks("size")).cast("int").alias("chunk"))
    tiles = tiles.withColumn("same", (F.col("a") == F.col("b")) & (F.col("i") == F.col("j")))
    left = tiles.select("a", "b", "i", "j", "same", F.col("a").alias("ball"), F.col("i").alias("chunk"), F.lit(0).alias("side"))
    right = tiles.where("not same").select("a", "b", "i", "j", "same", F.col("b").alias("ball"), F.col("j").alias("chunk"), F.lit(1).alias("side"))
    sides = left.unionByName(right).join(members.hint("merge"), ["ball", "chunk"])
    packed = sides.groupBy("a", "b", "i", "j", "same").agg(F.collect_list(F.struct("side", "id", "u", "weight")).alias("rows"))
    packed.select("a", "b", "rows", "same").mapInPandas(_tiles(min_cosine), "id long, links long, a long, b long").write.parquet(f"{path}/exact")
    exact = spark.read.parquet(f"{path}/exact")
    links = sure.unionByName(exact.select("id", "links")).groupBy("id").agg(F.sum("links").alias("links"))
    # balls linked as a whole, or with a link found in a tile, are one component
    return links, pairs.where("all and a != b").select("a", "b").unionByName(exact.where("a != b").select("a", "b").distinct())


def _exact_counts(shared, min_cosine: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(shared.value["ids"]), dtype=np.int64)
        for f in frames:
            for width, rows in f.groupby(f["u"].map(len), sort=False):
                if width in shared.value["by_width"]:
                    at, u = shared.value["by_width"][width]
                    near = u @ _matrix(rows["u"], np.float64).T >= min_cosine
                    total[at] += near @ rows["weight"].to_numpy(dtype=np.int64)
        yield pd.DataFrame({"id": shared.value["ids"], "true_links": total})

    return run


def audit(vectors: DataFrame, links: DataFrame, min_cosine: float = MIN_COSINE, size: int = AUDIT) -> float:
    """Share of the true links of ``size`` vectors, chosen by hash, that ``links`` (id, links) has. One scan, no shuffle of vectors."""
    spark = vectors.sparkSession
    chosen = vectors.select("id", "u").orderBy(F.xxhash64("id", F.lit(17)), "id").limit(size).toPandas()  # bounded by size
    if chosen.empty:
        return 1.0
    by_width = {w: (rows.index.to_numpy(), _matrix(rows["u"], np.float64)) for w, rows in chosen.groupby(chosen["u"].map(len))}
    shared = spark.sparkContext.broadcast({"ids": chosen["id"].to_numpy(), "by_width": by_width})
    true = vectors.select("u", "weight").mapInPandas(_exact_counts(shared, min_cosine), "id long, true_links long")
    true = true.groupBy("id").agg(F.sum("true_links").alias("true_links"))
    own = vectors.select("id", "weight").join(F.broadcast(true), "id").select("id", (F.col("true_links") - F.col("weight")).alias("true_links"))
    both = own.join(links, "id", "left").agg(
        F.sum(F.least(F.coalesce("links", F.lit(0)), "true_links")).alias("found"), F.sum("true_links").alias("true")).first()
    shared.destroy()
    return both["found"] / both["true"] if both["true"] else 1.0


def link_vectors(rows: DataFrame, min_cosine: float = MIN_COSINE, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
                 audit_size: int = AUDIT, min_recall: float = MIN_RECALL) -> DataFrame:
    """(id, n_links, component_id, kept, n_copies, audit_recall) of every vector of the table."""
    spark = rows.sparkSession
    path = shared_path(spark, "vectors")
    table = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fit = usable("v") & F.exists("v", lambda x: x != 0)
    table = table.where("id is not null").groupBy("id").agg(F.min("v").alias("v")).withColumn("fit", F.coalesce(fit, F.lit(False)))
    # -0.0 and 0.0 are the same component
    table = table.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    table.write.parquet(f"{path}/rows")
    table = spark.read.parquet(f"{path}/rows")
    classes = table.where("fit").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    classes.write.parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")
    units = classes.select("id", "v").mapInPandas(_units, "id long, u binary, x binary, d int, code array<bigint>")
    units.join(classes.select("id", "weight").hint("merge"), "id").write.parquet(f"{path}/units")
    vectors = spark.read.parquet(f"{path}/units")
    for attempt in range(ATTEMPTS):
        links, comps = _links(vectors, f"{path}/{attempt}", min_cosine, k << attempt)
        recall = audit(vectors, links, min_cosine, audit_size)
        if recall >= min_recall:
            break
    found = classes.select("id", "v", "weight").join(links.hint("merge"), "id", "left").join(comps.hint("merge"), "id", "left")
    found = found.select(F.col("v").alias("w"), F.col("weight").alias("n_copies"), F.coalesce("comp", "id").alias("component_id"),
                         (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = table.join(found.hint("merge"), F.col("fit") & (F.col("v") == F.col("w")), "left")
    out = named.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       F.coalesce("component_id", "id").alias("component_id"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))
    unnamed = rows.where(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"),
        F.lit(1).cast("long").alias("n_copies"))
    out = out.unionByName(unnamed)
    kept = F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))
    return out.select(id_col, "n_links", "component_id", kept.alias("kept"), "n_copies", F.lit(float(recall)).alias("audit_recall"))


def _links(vectors: DataFrame, path: str, min_cosine: float, k: int) -> tuple[DataFrame, DataFrame]:
    """(id, links) and (id, comp) of the classes that are linked with another."""
    spark = vectors.sparkSession
    graph = neighbour_graph(_codes_of(vectors), f"{path}/graph", k)
    close = F.filter(F.arrays_zip("nb", "sim"), lambda e: e["sim"] >= min_cosine - 1e-4)
    listed = graph.select("id", (F.size(close) >= k).alias("full"), F.explode(close).alias("e"))
    listed = listed.select("full", F.col("id").alias("i"), F.col("e.nb").alias("j"))
    pairs = listed.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).distinct()
    _with_cosine(pairs, vectors, "a long, b long").where(F.col("cosine") >= min_cosine).write.parquet(f"{path}/edges")
    edges = spark.read.parquet(f"{path}/edges")
    comps = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    members = comps.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(
        comps.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
    members.write.parquet(f"{path}/comps")
    members = spark.read.parquet(f"{path}/comps")
    full = listed.where("full").select(F.col("i").alias("id")).distinct()
    dense = members.join(full.hint("merge"), "id").select("comp").distinct()
    inside, across = dense_links(vectors, members.join(dense.hint("merge"), "comp", "left_semi"), min_cosine, f"{path}/dense", k)
    thin = members.join(dense.hint("merge"), "comp", "left_anti").select("id")
    both = edges.select(F.col("a").alias("id"), F.col("b").alias("o")).unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("o")))
    listed_links = both.join(thin.hint("merge"), "id", "left_semi").join(vectors.select(F.col("id").alias("o"), "weight").hint("merge"), "o")
    links = inside.unionByName(listed_links.select("id", F.col("weight").alias("links"))).groupBy("id").agg(F.sum("links").alias("links"))
    links.write.parquet(f"{path}/links")
    across.write.parquet(f"{path}/across")
    across = spark.read.parquet(f"{path}/across")
    if across.limit(1).count():
        by = lambda n: members.select(F.col("id").alias(n), F.col("comp").alias(f"c{n}"))
        joined = across.join(by("a").hint("merge"), "a").join(by("b").hint("merge"), "b")
        merged = components(joined.select(F.col("ca").alias("u"), F.col("cb").alias("v"))).toDF("comp", "low")
        members = members.join(merged.hint("merge"), "comp", "left").select("id", F.coalesce("low", "comp").alias("comp"))
    return spark.read.parquet(f"{path}/links"), members
