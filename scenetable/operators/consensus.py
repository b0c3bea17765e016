"""The plane most points of a cloud agree on: hypotheses counted in one pass, refits by moments, the densest slab otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, small
from .fit import principal_frame
from .spacing import nearest_other

#: How much wider than the usual spacing a plane may be, the least tolerance, and the least points of a plane.
SPACINGS, LEAST, FEWEST = 1.4, 1e-5, 8
#: Parts of a slab's width that windows are first counted by.
GRAINS = 1024


def plane_tolerance(points: DataFrame, keys: list[str]) -> DataFrame:
    """1.4 times the median distance to the nearest other point of each cloud, places that are equal left out; at least 1e-5."""
    spaced = nearest_other(points, keys).groupBy(*keys).agg(F.percentile(F.when(F.col("d") > 1e-9, F.col("d")), 0.5).alias("m"))
    return spaced.select(*keys, F.greatest(F.lit(LEAST), F.coalesce(F.col("m") * SPACINGS, F.lit(LEAST))).alias("tolerance"))


def _minus(a: Column, b: Column) -> dict[str, Column]:
    return {c: a[c] - b[c] for c in "xyz"}


def _hypotheses(rows: DataFrame, keys: list[str], trials: int, seed: int) -> DataFrame:
    """Up to `trials` planes of each cloud through three of its points: keys and `planes`, an array.

    One point of each of 3 * trials buckets of a hash is picked by a minimum, so no cloud is sorted or gathered.
    """
    bucket = F.pmod(F.xxhash64(F.lit(seed), "point_id"), F.lit(3 * trials))
    one = rows.groupBy(*keys, bucket.alias("_b")).agg(F.min_by(F.struct("x", "y", "z"), F.struct(F.xxhash64(F.lit(seed + 1), "point_id"), F.col("point_id"))).alias("p"))
    held = one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_b", "p"))).alias("held"))
    pick = lambda t, j: F.get(F.col("held"), F.pmod(F.xxhash64(F.lit(seed + 2), t, F.lit(j)), F.size("held")).cast("int"))["p"]
    three = held.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(trials - 1)), lambda t: F.struct(t.alias("trial"), *(pick(t, j).alias(f"p{j}") for j in range(3)))).alias("t"))

    def plane(t: Column) -> Column:
        a, b = _minus(t["p1"], t["p0"]), _minus(t["p2"], t["p0"])
        n = {"nx": a["y"] * b["z"] - a["z"] * b["y"], "ny": a["z"] * b["x"] - a["x"] * b["z"], "nz": a["x"] * b["y"] - a["y"] * b["x"]}
        return F.struct(t["trial"].alias("trial"), F.sqrt(sum(c * c for c in n.values())).alias("size"), *(c.alias(k) for k, c in n.items()), t["p0"].alias("at"))

    def scaled(p: Column) -> Column:
        n = {k: p[k] / p["size"] for k in ("nx", "ny", "nz")}
        return F.struct(p["trial"].alias("trial"), *(c.alias(k) for k, c in n.items()), sum(n[f"n{a}"] * p["at"][a] for a in "xyz").alias("offset"))

    return three.select(*keys, F.transform(F.filter(F.transform("t", plane), lambda p: p["size"] > 1e-9), scaled).alias("planes"))


def _off() -> Column:
    return F.abs(F.col("nx") * F.col("x") + F.col("ny") * F.col("y") + F.col("nz") * F.col("z") - F.col("offset"))


def _fitted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The plane of least squares through each cloud: keys, nx, ny, nz, offset."""
    frame = principal_frame(rows, keys)
    n = {f"n{a}": F.get("axes", F.lit(6 + i)) for i, a in enumerate("xyz")}
    return checkpointed(frame.select(*keys, *(c.alias(k) for k, c in n.items()), sum(c * F.get("centre", F.lit(i)) for i, c in enumerate(n.values())).alias("offset")))


def _near(rows: DataFrame, keys: list[str], planes: DataFrame) -> DataFrame:
    """The rows of the clouds of `planes` within their tolerance of them."""
    return rows.join(small(planes, 1000), keys).where(_off() <= F.col("tolerance")).select(*rows.columns)


def _enough(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The clouds of enough rows, broadcast if they are few: a sort by cloud would gather each in one task."""
    return small(checkpointed(rows.groupBy(*keys).agg(F.count("*").alias("c"), F.max("fewest").alias("f")).where("c >= f").select(*keys)))


def consensus_planes(points: DataFrame, keys: list[str], trials: int = 256, min_fraction: float = 0.15, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The points on the plane that most of each cloud (keys, at least one; point_id, x, y, z) agree on, and the planes.

    Planes through three points are counted within `plane_tolerance`; the most points count, then the least median distance,
    then the first trial. The plane is fitted to its points twice, the second time if enough are near the first fit. A cloud
    in which fewer than 8 or `min_fraction` of the points agree, before or after, is left out of both results
    (`densest_slab` is for these). Returns (keys, point_id) kept and (keys, nx, ny, nz, offset, tolerance, n_points, kept).
    A point_id names one point; rows with null or non-finite coordinates and repeats do not count. Jobs run while the result is built.
    """
    finite = points
    for a in "xyz":
        finite = finite.where(F.col(a).isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    bare = checkpointed(finite.select(*keys, "point_id", *(F.col(a).cast("double").alias(a) for a in "xyz")).distinct())
    sizes = bare.groupBy(*keys).agg(F.count("*").alias("n_points")).withColumn("fewest", F.greatest(F.lit(FEWEST), F.ceil(F.col("n_points") * min_fraction)))
    known = checkpointed(plane_tolerance(bare, keys).join(sizes, keys))
    rows = bare.join(small(known, 1000), keys)
    planes = checkpointed(_hypotheses(bare, keys, trials, seed))
    flat = lambda df: df.select(*keys, F.explode("planes").alias("p")).select(*keys, "p.*")
    tried = rows.join(small(planes, 1000), keys).select(*rows.columns, F.explode("planes").alias("p")).select(*rows.columns, "p.*").where(_off() <= F.col("tolerance"))
    counts = checkpointed(tried.groupBy(*keys, "trial").agg(F.count("*").alias("c")))
    best = counts.join(counts.groupBy(*keys).agg(F.max("c").alias("c")), [*keys, "c"]).where("c >= 3")
    rivals = checkpointed(flat(planes).join(best, [*keys, "trial"]))
    middles = rows.join(small(rivals, 1000), keys).where(_off() <= F.col("tolerance")).groupBy(*keys, "trial").agg(F.percentile(_off(), 0.5).alias("m"))
    one = middles.groupBy(*keys).agg(F.min_by("trial", F.struct("m", "trial")).alias("trial"))
    first = checkpointed(_near(rows, keys, checkpointed(rivals.join(one, [*keys, "trial"]).select(*keys, "nx", "ny", "nz", "offset"))))
    first = first.join(_enough(first, keys), keys, "left_semi")
    fit = _fitted(first, keys)
    near = checkpointed(_near(rows, keys, fit))
    again = _enough(near, keys)
    refit = _fitted(near.join(again, keys, "left_semi"), keys)
    last = checkpointed(_near(rows, keys, refit).unionByName(first.join(again, keys, "left_anti")))
    last = last.join(_enough(last, keys), keys, "left_semi")
    found = refit.unionByName(fit.join(again, keys, "left_anti"))
    report = last.groupBy(*keys, "tolerance", "n_points").agg(F.count("*").alias("kept")).join(found, keys)
    return last.select(*keys, "point_id"), report.select(*keys, "nx", "ny", "nz", "offset", "tolerance", "n_points", "kept")


def densest_slab(points: DataFrame, keys: list[str], percentile: float = 96.0, thickness: float = 0.12, min_fraction: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """The points of the densest slab of each cloud across its axis of least spread, and a report.

    A slab is `thickness` times the larger extent in the plane wide (extents between the percentiles), and closed at both ends; of
    equally dense ones the lowest counts. All points are kept where the cloud is no thicker (mode `not_needed`) or fewer than 8 or
    `min_fraction` of them lie in it (`too_few`); else mode is `slab`. Windows are counted by parts of the width first, and point by point only where
    a part can hold the start of the densest. Returns (keys, point_id) and (keys, mode, n_points, kept, width).
    """
    rows = points.select(*keys, "point_id", *(F.col(a).cast("double").alias(a) for a in "xyz"))
    frame = checkpointed(principal_frame(rows, keys).select(*keys, F.col("n").alias("n_points"), "centre", "axes"))
    put = rows.join(small(frame, 1000), keys)
    along = lambda k: sum(F.get("axes", F.lit(3 * k + i)) * (F.col(a) - F.get("centre", F.lit(i))) for i, a in enumerate("xyz"))
    local = checkpointed(put.select(*keys, "point_id", "n_points", *(along(k).alias(f"l{k}") for k in range(3))))
    low = (100.0 - percentile) / 200.0
    spans = local.groupBy(*keys).agg(*(F.percentile(f"l{k}", F.array(F.lit(low), F.lit(1 - low))).alias(f"q{k}") for k in range(3)))
    long = [F.greatest(F.get(f"q{k}", F.lit(1)) - F.get(f"q{k}", F.lit(0)), F.lit(1e-5)) for k in range(3)]
    spans = spans.select(*keys, F.greatest(F.greatest(long[0], long[1]) * thickness, F.lit(1e-5)).alias("width"), long[2].alias("deep"))
    held = checkpointed(local.join(small(spans, 1000), keys).select(*keys, "point_id", "n_points", "width", (F.col("deep") > F.col("width")).alias("thick"), (F.col("l2") / F.col("width")).alias("s")))
    thick = held.where("thick").withColumn("j", F.floor(F.col("s") * GRAINS))
    bins = thick.groupBy(*keys, "j").agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys).orderBy("j")
    bins = bins.withColumn("most", F.sum("c").over(w.rangeBetween(0, GRAINS))).withColumn("inner", F.coalesce(F.sum("c").over(w.rangeBetween(1, GRAINS - 1)), F.lit(0)))
    bins = checkpointed(bins.withColumn("sure", F.max(F.greatest("c", "inner")).over(Window.partitionBy(*keys))).where(F.col("most") >= F.col("sure")).select(*keys, "j", "inner"))
    # A window from s holds the part's own points from s on, the parts between, and of the part a width on the points up to s + 1.
    ends = thick.select(*keys, (F.col("j") - GRAINS).alias("j"), (F.col("s") - 1).alias("s"), F.lit(0).alias("start"))
    window = Window.partitionBy(*keys, "j").orderBy("s")
    own = F.sum("start").over(window.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    on = F.sum(1 - F.col("start")).over(window.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    counted = thick.select(*keys, "j", "s", F.lit(1).alias("start")).union(ends).join(bins, [*keys, "j"]).withColumn("c", F.col("inner") + own + on).where("start = 1")
    top = counted.groupBy(*keys).agg(F.min_by("s", F.struct(-F.col("c"), F.col("s"))).alias("from"), F.max("c").alias("in_slab"))
    judged = held.join(small(checkpointed(top), 1000), keys, "left")
    fewest = F.greatest(F.lit(FEWEST), F.ceil(F.col("n_points") * min_fraction))
    mode = F.when(~F.col("thick"), "not_needed").when(F.col("in_slab") < fewest, "too_few").otherwise("slab")
    kept = judged.withColumn("mode", mode).where((F.col("mode") != "slab") | (F.col("s") - F.col("from")).between(0.0, 1.0))
    return kept.select(*keys, "point_id"), kept.groupBy(*keys, "mode", "n_points", "width").agg(F.count("*").alias("kept")).select(*keys, "mode", "n_points", "kept", "width")
