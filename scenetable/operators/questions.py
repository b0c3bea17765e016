"""Questions about objects: language, intent, ordinals, object resolution and answers."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import small

#: Terms that tell the two intents apart.
APPEARANCE = ("长什么", "什么样", "外观", "颜色", "材质", "看起来", "look like", "looks like", "appearance", "color", "colour", "material")
LOCATION = ("在哪里", "在哪", "哪里", "位置", "何处", "where", "located", "location")
#: Numerals after 第, ordinals in words, and nouns whose number names an instance.
NUMERALS = {"一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9, "十": 10}
ORDINALS = {"first": 1, "second": 2, "third": 3, "fourth": 4, "fifth": 5, "sixth": 6, "seventh": 7, "eighth": 8, "ninth": 9, "tenth": 10}
NUMBERED = "plant|植物|nightstand|床头柜|lamp|灯|window|窗|door|门|bed|床"
#: How a relation to {} is said in Chinese and in English.
RELATIONS = {
    "on_top_of": ("在{}上方", "on top of {}"), "supported_by": ("由{}支撑", "supported by {}"), "inside": ("在{}内部", "inside {}"), "near": ("在{}附近", "near {}"),
    "left_of": ("在{}左侧", "to the left of {}"), "right_of": ("在{}右侧", "to the right of {}"), "in_front_of": ("在{}前方", "in front of {}"), "behind": ("在{}后方", "behind {}"),
}
#: Where an object stands among equals if its id does not end in a number.
_LAST = 10**9


@F.pandas_udf(StringType())
def _compatible(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


def folded(text: Column) -> Column:
    """Compatibility forms unified and case folded; Python sees only text beyond ASCII."""
    plain = text.rlike(r"^\p{ASCII}*$")
    return F.when(plain, F.lower(text)).otherwise(_compatible(F.when(~plain, text)))


def normalize_text(text: Column) -> Column:
    """Letters and digits only, of `folded` text."""
    return F.regexp_replace(folded(text), r"[^\p{L}\p{N}]", "")


def language(text: Column) -> Column:
    return F.when(text.rlike(r"[\u3400-\u9fff]"), "zh").otherwise("en")


def intent(text: Column) -> Column:
    low = folded(text)
    return F.when(low.rlike("|".join(APPEARANCE)), "appearance").when(low.rlike("|".join(LOCATION)), "location").otherwise("unknown")


def ordinal(text: Column) -> Column:
    """The instance asked for: a number after 第, else an ordinal word, else the number of a listed noun; null without any."""
    low = folded(text)
    said = F.regexp_extract(low, "第\\s*([一二两三四五六七八九十]|[0-9]+)", 1)
    counted = F.coalesce(*(F.when(said == w, n) for w, n in NUMERALS.items()), said.try_cast("int"), F.lit(0))
    words = (F.when(low.rlike(rf"(?U)\b{w}\b"), n) for w, n in ORDINALS.items())
    return F.when(said != "", counted).otherwise(F.coalesce(*words, F.regexp_extract(low, rf"(?U)(?:{NUMBERED})\s*[_#-]?\s*0*([0-9]+)\b", 1).try_cast("int")))


def object_terms(objects: DataFrame) -> DataFrame:
    """Terms of objects (object_id, scoped_id, names array, aliases array, category) with fixed weights; the best for each key.

    Weights: 1000 scoped id, 900 id, 800 names, 600 aliases, 400 category, plus min(key length, 99).
    """
    kinds = F.concat(
        F.array(F.struct(F.col("scoped_id").alias("term"), F.lit(1000).alias("w")), F.struct(F.col("object_id").alias("term"), F.lit(900).alias("w")), F.struct(F.col("category").alias("term"), F.lit(400).alias("w"))),
        F.transform("names", lambda t: F.struct(t.alias("term"), F.lit(800).alias("w"))),
        F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda t: F.struct(t.alias("term"), F.lit(600).alias("w"))),
    )
    rows = objects.select("object_id", "scoped_id", F.explode(kinds).alias("k")).select("object_id", "scoped_id", normalize_text(F.col("k.term")).alias("key"), "k.w").where(F.length("key") > 0)
    return rows.groupBy("object_id", "scoped_id", "key").agg((F.max("w") + F.least(F.length("key"), F.lit(99))).alias("weight"))


def resolve(questions: DataFrame, objects: DataFrame) -> DataFrame:
    """What each question (question_id, text) is about: object_id, n_best, score and status.

    An object's score is its best term contained in the question. One best object: resolved; several:
    ambiguous, unless an ordinal picks one in order of trailing number (without one last) and scoped id; none: not_found.
    """
    asked = questions.select("question_id", "text", normalize_text(F.col("text")).alias("q"), ordinal(F.col("text")).alias("nth"))
    hits = asked.join(small(object_terms(objects)), F.contains(F.col("q"), F.col("key"))).groupBy("question_id", "nth", "object_id", "scoped_id").agg(F.max("weight").alias("score"))
    number = F.coalesce(F.regexp_extract("object_id", r"([0-9]+)$", 1).try_cast("long"), F.lit(_LAST))
    best = hits.withColumn("top", F.max("score").over(Window.partitionBy("question_id"))).where(F.col("score") == F.col("top"))
    order = Window.partitionBy("question_id").orderBy(number, "scoped_id")
    best = best.withColumns({"place": F.row_number().over(order), "n_best": F.count("*").over(Window.partitionBy("question_id"))})
    one = best.groupBy("question_id").agg(
        F.max("n_best").alias("n_best"),
        F.max("score").alias("score"),
        F.coalesce(F.max(F.when(F.col("n_best") == 1, F.col("object_id"))), F.max(F.when(F.col("place") == F.col("nth"), F.col("object_id")))).alias("object_id"),
    )
    status = F.when(F.col("n_best").isNull(), "not_found").when(F.col("object_id").isNull(), "ambiguous").otherwise("resolved")
    return asked.join(one, "question_id", "left").withColumn("status", status).select("question_id", "object_id", F.coalesce("n_best", F.lit(0)).alias("n_best"), "score", "status")


def relation_text(predicate: Column, target: Column, lang: int) -> Column:
    """A relation in words, Chinese (0) or English (1); null for a predicate without words."""
    return F.coalesce(*(F.when(predicate == p, F.concat(F.lit(said[lang].split("{}")[0]), target, F.lit(said[lang].split("{}")[1]))) for p, said in RELATIONS.items()))


def answer(questions: DataFrame, objects: DataFrame, relations: DataFrame) -> DataFrame:
    """Answers with status: resolved, ambiguous, not_found, unavailable or unsupported.

    Location: the object's own description, else its verified relations of confidence 0.5 or more in
    words (surest first, then by target), else the centre of its box. Appearance: its description.
    """
    asked = questions.withColumns({"lang": language(F.col("text")), "intent": intent(F.col("text"))})
    said = relations.where(F.col("verified") & (F.col("confidence") >= 0.5)).select(F.col("subject").alias("object_id"), (-F.col("confidence")).alias("c"), "target", *(relation_text(F.col("predicate"), F.col("target"), i).alias(n) for i, n in enumerate(("zh", "en"))))
    listed = F.array_sort(F.collect_list(F.struct("c", "target", "zh", "en")))
    told = said.where("en IS NOT NULL").groupBy("object_id").agg(listed.alias("a")).select("object_id", F.array_join("a.zh", ", ").alias("told_zh"), F.array_join("a.en", "; ").alias("told_en"))
    rows = asked.join(resolve(questions, objects), "question_id").join(small(objects.select("object_id", "location", "appearance", "box_min", "box_max")), "object_id", "left").join(told, "object_id", "left")
    relation = F.when(F.col("lang") == "zh", F.col("told_zh")).otherwise(F.col("told_en"))
    centre = F.when(F.col("box_min").isNotNull(), F.format_string("centre (%.2f, %.2f, %.2f)", *((F.col("box_min")[i] + F.col("box_max")[i]) / 2 for i in range(3))))
    text = F.when(F.col("intent") == "location", F.coalesce("location", relation, centre)).when(F.col("intent") == "appearance", F.col("appearance"))
    status = F.when(F.col("status") != "resolved", F.col("status")).when(F.col("intent") == "unknown", "unsupported").when(text.isNull(), "unavailable").otherwise("resolved")
    return rows.select("question_id", "lang", "intent", "object_id", status.alias("status"), F.when(status == "resolved", text).alias("answer"))


def classify_command(text: Column) -> Column:
    """The kind of a scene command: delete, reparent, split, merge, add, update or query."""
    low = F.lower(text)
    kinds = (("delete", r"\b(delete|remove|erase)\b|删除|移除"), ("reparent", r"\b(attach|parent|move .* (under|onto))\b|挂到"), ("split", r"\bsplit\b|拆分"), ("merge", r"\b(merge|combine)\b|合并"), ("add", r"\b(add|create|insert)\b|添加|新增"), ("update", r"\b(update|rename|set|change)\b|修改|更新"))
    return F.coalesce(*(F.when(low.rlike(p), kind) for kind, p in kinds), F.lit("query"))
