"""Evidence and contract checks: audits, coverage, digests, lineage, gates, routing, violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small


def canonical_category(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """Lower-cased, runs of other signs than letters, digits and CJK made one underscore; aliases first."""
    plain = F.lower(F.trim(name))
    clean = F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9一-鿿]+", "_"), r"^_+|_+$", "")
    if not aliases:
        return clean
    table = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
    return F.coalesce(table[plain], clean)


def audit_merge(audits: DataFrame, keys: list[str], frames: int = 6) -> DataFrame:
    """Merge audits by category: the greatest count, a representative, the best frames and the strongest importance.

    Rows: keys, run_id, n, confidence, importance (primary, structure, secondary), frame_id. Counts merge by maximum.
    """
    rank = F.when(F.col("importance") == "primary", 0).when(F.col("importance") == "structure", 1).otherwise(2)
    rows = audits.withColumn("_i", rank)
    order = Window.partitionBy(*keys).orderBy(F.desc("confidence"), "frame_id")
    best = rows.groupBy(*keys, "frame_id").agg(F.max("confidence").alias("confidence")).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= frames)
    listed = best.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "frame_id"))), lambda s: s["frame_id"].cast("string")), ",").alias("frames"))
    merged = rows.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.min_by("run_id", F.struct(-F.col("n"), -F.col("confidence"), F.col("run_id"))).alias("representative"),
        F.min("_i").alias("_i"),
    )
    out = merged.withColumn("importance", F.when(F.col("_i") == 0, "primary").when(F.col("_i") == 1, "structure").otherwise("secondary")).drop("_i")
    return out.join(listed, keys)


def coverage(observed: DataFrame, assets: DataFrame) -> DataFrame:
    """What each observed category still needs: observed (category, n) against assets (category, represented, individual, state)."""
    action = (
        F.when(F.col("represented").isNull() | (F.col("represented") < F.coalesce("n", F.lit(0))), F.when(F.col("individual"), "instance_split").otherwise("segment"))
        .when(F.col("n").isNull(), "unassessed")
        .when(F.col("state") == "candidate", "segment")
        .when(F.col("state").isin("segmented", "review_failed"), "complete")
        .when(F.col("state") == "completed", "review")
        .otherwise("none")
    )
    return observed.join(assets, "category", "full_outer").withColumn("action", action)


def asset_coverage(observed: DataFrame, assets: DataFrame) -> DataFrame:
    """How far assets cover the observed instances of each category, and what is to be done next.

    observed: category, n; assets: category, asset_id, scope (individual or group), represented, state. Returns category, n, represented, individual (instances
    that individual assets represent), status and next_action. No asset: missing, segment. Fewer represented than observed: undercovered,
    segment; fewer by individual assets: undercovered, instance_split. Else covered, by the states of individual assets: a candidate is to be segmented, one segmented or
    failed in review completed, a completed one reviewed. Categories with assets that were not observed are unassessed, none.
    """
    own = F.col("scope") == "individual"
    held = assets.groupBy("category").agg(F.sum("represented").alias("represented"), F.sum(F.when(own, F.col("represented")).otherwise(0)).alias("individual"), F.collect_set(F.when(own, F.col("state"))).alias("states"))
    has = lambda *s: F.arrays_overlap("states", F.array(*map(F.lit, s)))
    next_ = (
        F.when(F.col("n").isNull(), "none").when(F.col("represented").isNull() | (F.col("represented") < F.col("n")), "segment").when(F.col("individual") < F.col("n"), "instance_split")
        .when(has("candidate"), "segment").when(has("segmented", "review_failed"), "complete").when(has("completed"), "review").otherwise("none")
    )
    status = F.when(F.col("n").isNull(), "unassessed").when(F.col("represented").isNull(), "missing").when(F.least("represented", "individual") < F.col("n"), "undercovered").otherwise("covered")
    rows = observed.select("category", "n").join(held, "category", "full_outer")
    return rows.select("category", "n", F.coalesce("represented", F.lit(0)).alias("represented"), F.coalesce("individual", F.lit(0)).alias("individual"), status.alias("status"), next_.alias("next_action"))


def digest_issues(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of `declared` (uri, sha256, size_bytes) that `actual` lacks or contradicts: uri and issue."""
    a = actual.select("uri", F.col("sha256").alias("_s"), F.col("size_bytes").alias("_n"))
    issue = F.when(F.col("_s").isNull(), "missing").when(F.col("_n") != F.col("size_bytes"), "size_mismatch").when(F.col("_s") != F.col("sha256"), "sha256_mismatch")
    return declared.join(a, "uri", "left").withColumn("issue", issue).where(F.col("issue").isNotNull()).select("uri", "issue")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def set_digest(rows: DataFrame, keys: list[str], part: Column, bucket_digits: int = 3) -> DataFrame:
    """One sha256 for the parts of each key, whatever their order, in two levels.

    Parts are dealt to buckets by the first hex digits of their own sha256; a bucket's digest is over its sorted
    parts, and a key's over the lines bucket:digest in order. So no list holds more than a bucket of a key, and
    a very large key is spread over all tasks. Null parts are left out.
    """
    dealt = rows.select(*keys, part.alias("_part")).withColumn("_bucket", F.substring(F.sha2("_part", 256), 1, bucket_digits))
    each = dealt.groupBy(*keys, "_bucket").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("_part")), "\n"), 256).alias("_digest"))
    lines = F.sort_array(F.collect_list(F.concat_ws(":", "_bucket", "_digest")))
    return each.groupBy(*keys).agg(F.sha2(F.array_join(lines, "\n"), 256).alias("digest"))


def lineage_breaks(receipts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rounds whose input is not the output of the round before, or whose index does not follow it."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = receipts.withColumns({"_out": F.lag("output_sha256").over(w), "_at": F.lag(order).over(w)})
    issue = F.when(F.col("_at") + 1 != F.col(order), "gap").when(F.col("_out") != F.col("input_sha256"), "digest_break")
    return rows.withColumn("issue", issue).where(F.col("issue").isNotNull()).select(*keys, order, "issue")


def gate_worst(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The worst value of each metric over frames against its threshold (metric, op ">=" or "<=", bound): worst, passed, n_failed.

    A metric without any value fails.
    """
    rows = metrics.join(small(thresholds), "metric")
    ok = F.coalesce(F.when(F.col("op") == ">=", F.col("value") >= F.col("bound")).otherwise(F.col("value") <= F.col("bound")), F.lit(False))
    out = rows.groupBy("metric", "op", "bound").agg(
        F.when(F.first("op") == ">=", F.min("value")).otherwise(F.max("value")).alias("worst"),
        F.bool_and(ok).alias("passed"),
        F.count_if(~ok).alias("n_failed"),
    )
    return out


#: Categories with a deformable profile and those that a rigid CAD model can stand for.
DEFORMABLE = ("bean bag", "cushion", "pillow", "seat cushion", "throw pillow")
RIGID = ("cabinet", "chair", "door", "lamp", "nightstand", "stool", "table", "vase")
#: Completion backends with their scores. Rules in SQL over the evidence, with `kind` as the category's key.
BACKENDS = (
    ("support_surface_reconstruction", 98, "target_kind = 'structure_background' AND support_geometry_available"),
    ("component_assembly", 97, "target_kind = 'fixture' AND support_geometry_available AND multi_depth_negative_space_verified"),
    ("multi_view_reconstruction", 96, "calibrated_view_count >= 3 AND view_baseline_score >= 0.05 AND estimated_visible_surface_fraction >= 0.35"),
    ("deformable_category_prior", 88, f"source_front_rgba_available AND (deformable_prior_available OR kind IN {DEFORMABLE})"),
    ("retrieval_cad_prior", 82, f"kind IN {RIGID} AND cad_retrieval_confidence >= 0.82"),
    ("generative_image_to_3d", 70, "source_front_rgba_available"),
)
HOLD = "hold_for_more_evidence"


def route(evidence: DataFrame) -> DataFrame:
    """The eligible backend of highest score for each row of evidence: object_id, backend, score.

    Without a verified identity and appearance the object is held (score 100); with them, holding (score 1)
    remains if nothing else is eligible. A category's key is lowered, "_" and white space being one
    space. Null evidence counts as not given.
    """
    rows = evidence.withColumn("kind", F.lower(F.btrim(F.regexp_replace("category", r"[\s_]+", " "))))
    verified = F.coalesce(F.col("same_instance_multi_frame_verified") & F.col("appearance_contract_verified"), F.lit(False))
    ways = [F.when(F.coalesce(F.expr(rule), F.lit(False)), F.struct(F.lit(score).alias("score"), F.lit(name).alias("backend"))) for name, score, rule in BACKENDS]
    hold = lambda score: F.struct(F.lit(score).alias("score"), F.lit(HOLD).alias("backend"))
    best = F.when(verified, F.coalesce(*ways, hold(1))).otherwise(hold(100))
    return rows.select("object_id", best.alias("b")).select("object_id", "b.backend", "b.score")


def violations(rules: dict[str, DataFrame]) -> DataFrame:
    """One table of rule and key from queries that each give a column `key`."""
    return reduce(DataFrame.union, [df.select(F.lit(rule).alias("rule"), F.col("key").cast("string").alias("key")) for rule, df in rules.items()])
