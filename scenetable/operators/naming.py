"""Objects named in questions by whole words, instances known to be missing, and relations told from either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small
from .questions import folded

#: The rank of a term's kind, words that stand for the selected object, and relations in words from the subject's and the object's side.
KINDS = {"id": 0, "name": 1, "alias": 2, "category": 3}
PRONOUNS = ("it", "this object", "它", "这个", "该物体")
RELATION_WORDS = {
    "OnTopOf": {"zh": ("位于其上方", "位于其下方"), "en": ("on top of", "under")},
    "SupportedBy": {"zh": ("由其支撑", "支撑"), "en": ("supported by", "supports")},
    "Near": {"zh": ("靠近", "靠近"), "en": ("near", "near")},
}


def spaced(text: Column) -> Column:
    """`folded` text with each run of punctuation, symbols and white space as one space, and none at the ends."""
    return F.trim(F.regexp_replace(folded(text), r"[\p{P}\p{S}\s\p{Z}]+", " "))


def _han(key: Column) -> Column:
    return key.rlike(r"^\p{IsHan}+$")


def spoken_keys(questions: DataFrame, words: int, characters: int) -> DataFrame:
    """Every key that a question (question_id, q) can hold: runs of up to so many words, and pieces of Han text of up to so many characters.

    A key that a term must equal, so that questions and terms meet by equality: rows go with a question's length times the bound.
    """
    cut = F.split("q", " ")
    runs = F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(words), F.size("w") - i + 1)), lambda n: F.array_join(F.slice("w", i, n), " ")))
    latin = questions.where("q <> ''").select("question_id", cut.alias("w")).select("question_id", F.explode(F.array_distinct(F.flatten(runs))).alias("key")).where(~_han(F.col("key")))
    pieces = F.transform(F.sequence(F.lit(1), F.length("q")), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(characters), F.length("q") - i + 1)), lambda n: F.substring("q", i, n)))
    han = questions.where(F.col("q").rlike(r"\p{IsHan}")).select("question_id", F.explode(F.array_distinct(F.flatten(pieces))).alias("key")).where(_han(F.col("key")))
    return latin.union(han)


def resolve_named(questions: DataFrame, terms: DataFrame, missing: DataFrame) -> DataFrame:
    """Which object each question (question_id, text, selected_id) names, by whole words in Latin and by containment in Han.

    terms: object_id, term, kind (id, name, alias, category); missing: term, instances known not to be there, which are
    told before anything else. Of the kinds found the best counts: one object is resolved, several are ambiguous. Without any, a
    pronoun stands for the selected object (null: none). Returns question_id, status (resolved, ambiguous, missing-instance, not-found, empty),
    object_id, term (the missing one, the least if several) and candidates (ids, ascending). Terms without letters or digits are left out.
    """
    asked = questions.select("question_id", "selected_id", F.coalesce(spaced(F.col("text")), F.lit("")).alias("q"))
    rank = F.coalesce(*(F.when(F.col("kind") == k, n) for k, n in KINDS.items()), F.lit(9))
    known = terms.select("object_id", spaced(F.col("term")).alias("key"), rank.alias("rank")).where("key <> ''").distinct()
    gone = missing.select(spaced(F.col("term")).alias("key")).where("key <> ''").distinct()
    sizes = known.select("key").union(gone).agg(F.max(F.when(~_han(F.col("key")), F.size(F.split("key", " ")))).alias("w"), F.max(F.when(_han(F.col("key")), F.length("key"))).alias("c")).first()
    keys = spoken_keys(asked, sizes.w or 1, sizes.c or 1)
    hits = keys.join(small(known), "key")
    best = hits.withColumn("_b", F.min("rank").over(Window.partitionBy("question_id"))).where(F.col("rank") == F.col("_b")).groupBy("question_id").agg(F.array_sort(F.collect_set("object_id")).alias("found"))
    absent = keys.join(small(gone), "key").groupBy("question_id").agg(F.min("key").alias("term"))
    rows = asked.join(best, "question_id", "left").join(absent, "question_id", "left")
    said = F.exists(F.array(*map(F.lit, PRONOUNS)), lambda p: F.contains(F.col("q"), p))
    owns = F.col("selected_id").isNotNull() & said
    there = rows.join(small(terms.select(F.col("object_id").alias("selected_id")).distinct().withColumn("_s", F.lit(True))), "selected_id", "left")
    status = (
        F.when(F.col("q") == "", "empty").when(F.col("term").isNotNull(), "missing-instance").when(F.size("found") == 1, "resolved").when(F.size("found") > 1, "ambiguous").when(owns & F.col("_s"), "resolved").otherwise("not-found")
    )
    one = F.when(F.col("status") == "resolved", F.coalesce(F.get("found", F.lit(0)), "selected_id"))
    out = there.withColumn("status", status)
    return out.select("question_id", "status", one.alias("object_id"), F.when(F.col("status") == "missing-instance", F.col("term")).alias("term"), F.when(F.col("status") == "ambiguous", F.col("found")).otherwise(F.array().cast("array<string>")).alias("candidates"))


def told_relations(objects: DataFrame, relations: DataFrame) -> DataFrame:
    """What can be said of each object (object_id, name) from its first verified relation, from either side: object_id, zh, en.

    relations: ord, subject, predicate, object, target_zh, target_en, confidence (null counts as sure), verified; those under 0.5 do not
    count. From the subject's side the target's own label names the other, else, and from the object's side, the other's name or id.
    Predicates without words are told by their names.
    """
    sure = relations.where(F.col("verified") & (F.col("confidence").isNull() | (F.col("confidence") >= 0.5)))
    both = sure.select(F.col("subject").alias("object_id"), F.col("object").alias("other"), F.lit(0).alias("side"), "ord", "predicate", "target_zh", "target_en")
    both = both.union(sure.where(F.col("subject") != F.col("object")).select("object", "subject", F.lit(1), "ord", "predicate", F.lit(None).cast("string"), F.lit(None).cast("string")))
    first = both.groupBy("object_id").agg(F.min_by(F.struct("other", "side", "predicate", "target_zh", "target_en"), "ord").alias("r")).select("object_id", "r.*")
    named = first.join(objects.select("object_id"), "object_id", "left_semi").join(objects.select(F.col("object_id").alias("other"), "name"), "other", "left")

    def told(lang: str, other: str) -> Column:
        words = F.coalesce(*(F.when(F.col("predicate") == p, F.when(F.col("side") == 0, said[lang][0]).otherwise(said[lang][1])) for p, said in RELATION_WORDS.items()), F.col("predicate"))
        label = F.coalesce(F.nullif(F.trim(F.col(f"target_{lang}")), F.lit("")), F.nullif(F.trim(F.col(f"target_{other}")), F.lit("")), "name", "other")
        return F.concat_ws(" ", words, label).alias(lang)

    return named.select("object_id", told("zh", "en"), told("en", "zh"))
