"""Line dedup: lines that recur across documents stay in one document only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, staged


def _key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hash(key: Column) -> Column:
    """128 bits from two seeds, so that a corpus of 10^12 lines meets no chance collision."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop recurring lines of `docs` (doc_id, text, ...) except in the largest doc_id that holds them.

    A line's key is the line stripped of blanks and with A-Z lowered. Keys of at least
    `min_chars` code points in at least `min_docs` documents lose their lines. Returns the
    columns of `docs`, `text` rewritten, plus n_lines and n_dropped.

    Null or empty text: one empty line. Rows repeated under one doc_id are one document, and all of
    them keep a line that their doc_id may keep. Rows with a null doc_id are no document: they
    neither count nor lose a line. Columns named n_lines or n_dropped in the input are replaced.
    Empty input: empty output.

    Only hashes and positions are shuffled: each line is a row (doc_id, a hash of the text, position, hash of the key), the
    positions to drop are collected by document and text, and the rest is put together by position, in time
    linear in the lines. Counting goes by (hash, doc_id) first, so a line that very many documents hold is counted in many
    tasks. Owners are written before they are joined back, so both sides of that join are plain
    shuffles, which adaptive execution splits at a hot line.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    text = F.xxhash64(F.coalesce("text", F.lit("")))  # tells rows of one doc_id apart
    keyed = docs.select("doc_id", text.alias("t"), F.posexplode(F.transform(lines, _key)).alias("pos", "k")).where(F.char_length("k") >= min_chars)
    seen = staged(keyed.select("doc_id", "t", "pos", _hash(F.col("k")).alias("h")).select("doc_id", "t", "pos", "h.a", "h.b"))
    owners = staged(seen.groupBy("a", "b").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("owner")).where(F.col("n") >= min_docs).drop("n"))
    gone = seen.join(owners, ["a", "b"]).where(F.col("doc_id") < F.col("owner"))
    drops = gone.groupBy(F.col("doc_id").alias("__id"), F.col("t").alias("__t")).agg(F.collect_set("pos").alias("__drop"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__drop")
    kept = F.when(F.col("__drop").isNotNull(), F.transform(stay, lambda i: F.get("__lines", i))).otherwise(F.col("__lines"))
    out = (
        docs.join(drops.hint("shuffle_hash"), (docs["doc_id"] == drops["__id"]) & (text == drops["__t"]), "left")
        .withColumn("__lines", lines)
        .withColumn("__kept", kept)
        .withColumns({
            "text": F.array_join("__kept", "\n"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dropped": (F.size("__lines") - F.size("__kept")).cast("long"),
        })
    )
    return out.drop("__id", "__t", "__drop", "__lines", "__kept")


def query(spark, sf_dir):
    from .common import table

    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(p) AS l, generate_subscripts(p, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents))
), keys AS (
  SELECT k, max(doc_id) AS owner FROM lines WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, i, l, coalesce(doc_id < owner, false) AS gone FROM lines LEFT JOIN keys USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
