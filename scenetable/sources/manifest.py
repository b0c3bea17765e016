"""World manifests (JSON documents) as tables of objects, relations and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TEXT = "struct<zh: string, en: string>"
#: One document a file; fields that are not named here are left out, a document that is none fails.
SCHEMA = f"""world_id string, objects array<struct<id: string, name: {_TEXT}, category: string, aliases: array<string>, parent_object_id: string,
 bbox_scene: struct<frame_id: string, min: array<double>, max: array<double>>,
 relations: array<struct<predicate: string, target_object_id: string, target_label: {_TEXT}, confidence: double, verified: boolean>>,
 quality_gates: array<struct<gate: string, status: string, report_sha256: string, metrics: map<string, string>>>>>"""


def snake_case(name: Column) -> Column:
    """A predicate such as OnTopOf, on-top of or on_top_of as on_top_of."""
    parted = F.regexp_replace(F.regexp_replace(name, r"(?<!^)(?=\p{Lu})", "_"), "[- ]", "_")
    return F.lower(F.regexp_replace(F.regexp_replace(parted, "_+", "_"), "^_|_$", ""))


def read_manifests(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of the manifests at `path`: objects, relations (predicates in snake case) and gates, each with world_id.

    A world without an id, an object without one, an id twice in a world, or a predicate that is no name raise when the table `issues` is not
    empty; that is for the caller to look at: world_id, object_id, issue.
    """
    docs = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    each = docs.select("world_id", F.posexplode("objects").alias("ord", "o"))
    objects = each.select(
        "world_id", "ord", F.col("o.id").alias("object_id"), F.concat_ws(":", "world_id", "o.id").alias("scoped_id"), "o.name", "o.category", F.coalesce("o.aliases", F.array().cast("array<string>")).alias("aliases"), "o.parent_object_id",
        F.col("o.bbox_scene.frame_id").alias("bbox_frame"), F.col("o.bbox_scene.min").alias("bbox_min"), F.col("o.bbox_scene.max").alias("bbox_max"),
    )
    relations = each.select("world_id", F.col("o.id").alias("subject"), F.posexplode("o.relations").alias("ord", "r")).select("world_id", "subject", "ord", snake_case(F.col("r.predicate")).alias("predicate"), "r.target_object_id", "r.target_label", "r.confidence", F.coalesce("r.verified", F.lit(False)).alias("verified"))
    gates = each.select("world_id", F.col("o.id").alias("object_id"), F.explode("o.quality_gates").alias("g")).select("world_id", "object_id", "g.gate", "g.status", "g.report_sha256", "g.metrics")
    named = "^[A-Za-z0-9_.-]+$"
    twice = objects.groupBy("world_id", "object_id").count().where("count > 1").select("world_id", "object_id", F.lit("id is used twice").alias("issue"))
    bad = objects.where(~F.coalesce(F.col("object_id").rlike(named), F.lit(False))).select("world_id", "object_id", F.lit("id is no name"))
    ends = relations.where(F.col("target_object_id").isNotNull()).join(objects.select("world_id", F.col("object_id").alias("target_object_id")), ["world_id", "target_object_id"], "left_anti").select("world_id", F.col("subject"), F.lit("relation leads nowhere"))
    odd = relations.where(~F.coalesce(F.col("predicate").rlike("^[a-z][a-z0-9_]*$"), F.lit(False))).select("world_id", "subject", F.lit("predicate is no name"))
    world = docs.where(~F.coalesce(F.col("world_id").rlike(named), F.lit(False))).select("world_id", F.lit(None).cast("string"), F.lit("world has no id"))
    return {"objects": objects, "relations": relations, "gates": gates, "issues": twice.union(bad).union(ends).union(odd).union(world)}
