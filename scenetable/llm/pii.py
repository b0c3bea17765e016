"""PII: pattern spans, and terms that the corpus shows to give a protected entity away.

Everything here is DataFrame functions: patterns, arrays, joins and aggregates in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table

#: Kinds in the order of the digest, with patterns in Java's syntax. Quantifiers are possessive
#: and starts are bound to the left edge of a run, which finds the same leftmost matches
#: without trying every tail of a long run. A card of under 12 digits never counts, so the
#: pattern asks for 12 at once.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
TERM, NO_TERM = r"[\p{L}\p{N}]++", r"[^\p{L}\p{N}]+"
#: Elements of a block of a running fold: arrays are grown to so many, never to their whole length.
STEP = 64
_FOUND = "struct<start:int,stop:int,value:string>"


def _running(items: Column, item: str, zero: Column, add: Callable, put: Callable, out: str) -> Column:
    """`put(acc, x)` for each x of `items` (array<item>), where acc is what `add` has made of `zero` and all before x.

    A fold over blocks of STEP gives each block's first acc, and one inside each block its results (of type `out`), so
    the work grows with the number of items and not with its square.
    """
    state = dict(item=f"array<struct<at:int,held:array<{item}>>>", out=f"array<{out}>")
    empty = lambda kind: F.array().cast(state[kind])
    one = lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(put(acc["at"], x))).alias("out"))
    cut = lambda acc, b: F.struct(F.aggregate(b, acc["at"], add).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), b.alias("held")))).alias("out"))

    def of(held: Column) -> Column:
        last = F.floor((F.size(held) - 1) / STEP).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(held, i * STEP + 1, F.lit(STEP)))
        begun = F.aggregate(blocks, F.struct(zero.alias("at"), empty("item").alias("out")), cut, lambda acc: acc["out"])
        done = F.flatten(F.transform(begun, lambda b: F.aggregate(b["held"], F.struct(b["at"].alias("at"), empty("out").alias("out")), one, lambda acc: acc["out"])))
        return F.when(F.size(held) > 0, done).when(held.isNotNull(), empty("out"))

    return _bound(items, of)


def _bound(value: Column, body: Callable) -> Column:
    """`body` of a value that is worked out once, as lambdas would work out an expression again for each element."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str) -> Column:
    """All matches as array<struct<start, stop, value>>, in code points; null text gives null.

    The pieces between matches give the positions: each match starts after all pieces and
    matches before it.
    """
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.struct(F.char_length(p).alias("gap"), m.alias("value")))
    end = lambda at, x: at + x["gap"] + F.char_length(x["value"])
    place = lambda at, x: F.struct((at + x["gap"]).alias("start"), end(at, x).alias("stop"), x["value"].alias("value"))
    return _running(pairs, "struct<gap:int,value:string>", F.lit(0), end, place, _FOUND)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn sum: every second one from the right doubled, less 9 above 9."""
    digits = F.split(F.reverse(_digits(value)), "")
    weighed = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    length = F.char_length(_digits(value))
    if kind == "ip":  # leading zeros may make a part long
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.char_length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    if kind == "card":
        return length.between(12, 19) & _luhn(value)
    if kind == "phone":
        return length.between(9, 15)
    return F.lit(True)


def _base(text: Column) -> Column:
    """All base spans of a text, by start and then kind: array<struct<start, k, stop, kind, value>>."""
    hint = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]"), "phone": F.contains(text, F.lit("+"))}
    none = F.array().cast("array<struct<start:int,k:int,stop:int,kind:string,value:string>>")

    def spans(k: int, kind: str) -> Column:
        good = F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("k"), m["stop"].alias("stop"), F.lit(kind).alias("kind"), m["value"].alias("value")))

    parts = [F.when(hint[kind], spans(k, kind)).otherwise(none) for k, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*parts))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find_spans(docs: DataFrame, disclosure: float = 0.95, removal: float = 0.99, support: int = 3) -> DataFrame:
    """Personal data in `docs` (doc_id, text, ...): base spans by pattern, and disclosing terms.

    A protected entity is a base span's kind and value (letters lowered; digits only, except
    for emails). A term t is a run of letters and digits, lowered. Over the documents of the
    corpus, with n(e) holding e, n(t) holding t, n(e,t) holding both, and N documents,

        PMI(e;t) = log(N n(e,t) / (n(e) n(t))),   IC(e) = log(N / n(e)).

    PMI / IC is the share of e's information that t gives away; 1 means that t occurs
    with e alone. If n(e,t) >= `support` and the share is at least `disclosure`, every
    occurrence of t in any text becomes a span, save where it meets a base span: kind "general"
    (to be generalised) if its largest share for any entity is below `removal`, "remove" from there on.
    An entity that all documents hold (IC 0) gives no spans.

    Returns per row doc_id, text (null: empty), spans (array<struct<start, k, stop, kind,
    value>>: code points, end exclusive, by start and kind) and base (the base spans alone).
    Null or empty text: no spans. Repeated rows each count as a document. A null doc_id is a
    document like any other. Other columns of the input are left out. Empty input: empty output.

    Rows get a number when their base spans are written. Equal texts are paired once, with their
    number as weight. As n(e,t) <= n(e), a share of s needs n(t) <= n(e) (N / n(e))^(1 - s), and both
    counts are at least `support`: pairs outside these bounds, which tell nothing, are not made. Words meet told
    terms by (row, term) and base spans by a sweep over positions, so time grows with a text's length.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", text.alias("text")).withColumn("base", _base(F.col("text")))
    base = staged(base.withColumn("row", F.monotonically_increasing_id()))
    n_docs = base.count()
    term = lambda w: F.xxhash64(F.lower(w))
    terms = F.array_distinct(F.transform(F.filter(F.split("text", NO_TERM), lambda w: w != ""), term))
    name = lambda s: F.when(s["kind"] == "email", F.lower(s["value"])).otherwise(F.concat(s["kind"], F.lit(":"), _digits(s["value"])))
    entities = F.array_distinct(F.transform("base", lambda s: F.xxhash64(name(s))))

    own = base.where(F.size("base") > 0).select(F.xxhash64("text").alias("tx"), entities.alias("es"), terms.alias("ts"))
    held = staged(own.groupBy("tx").agg(F.count("*").alias("w"), F.any_value("es").alias("es"), F.any_value("ts").alias("ts")))
    n_e = held.select("w", F.explode("es").alias("e")).groupBy("e").agg(F.sum("w").alias("n_e")).where((F.col("n_e") >= support) & (F.col("n_e") < n_docs))
    # rounding must not cost a pair: the bound is taken a little wider
    n_e = n_e.withColumn("most", F.col("n_e") * F.pow(F.lit(float(n_docs)) / F.col("n_e"), F.lit(1 - disclosure)) * 1.0001)
    in_docs = base.select("row", F.explode(terms).alias("t"))
    n_t = in_docs.groupBy("t").agg(F.count("*").alias("n_t")).where(F.col("n_t") >= support)
    some = held.select("tx", "w", F.explode("es").alias("e")).join(n_e, "e")
    with_terms = held.select("tx", F.explode("ts").alias("t")).join(n_t, "t")
    pairs = some.join(with_terms, "tx").where(F.col("n_t") <= F.col("most"))
    share = F.log(F.lit(float(n_docs)) * F.col("n_et") / (F.col("n_e") * F.col("n_t"))) / F.log(F.lit(float(n_docs)) / F.col("n_e"))
    pairs = pairs.groupBy("e", "t", "n_e", "n_t").agg(F.sum("w").alias("n_et")).where(F.col("n_et") >= support).withColumn("share", share)
    telling = staged(pairs.where(F.col("share") >= disclosure).groupBy("t").agg(F.max("share").alias("share")))

    # of rows that hold a told term: their words with positions, of which those told are kept by (row, t)
    told = staged(in_docs.join(telling, "t").select("row", "t", (F.col("share") >= removal).alias("gone")))
    mine = base.join(told.select("row").distinct(), "row", "left_semi").select("row", "text", "base")
    words = mine.select("row", F.explode(matches(F.col("text"), TERM)).alias("m")).select("row", "m.*", term(F.col("m.value")).alias("t"))
    events = words.join(told, ["row", "t"]).select("row", "start", "stop", "value", "gone")
    events = events.unionByName(mine.select("row", F.explode("base").alias("s")).select("row", "s.start", "s.stop"), allowMissingColumns=True)
    # a word meets a base span that began before it and goes on, or one that begins within it
    order = Window.partitionBy("row").orderBy("start")
    basic = F.col("value").isNull()
    before = F.max(F.when(basic, F.col("stop"))).over(order.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(basic, F.col("start"))).over(order.rangeBetween(0, Window.unboundedFollowing))
    free = events.withColumns({"before": before, "after": after}).where(~basic & (F.col("before").isNull() | (F.col("before") <= F.col("start"))) & (F.col("after").isNull() | (F.col("after") >= F.col("stop"))))
    span = F.struct("start", F.when(F.col("gone"), len(KINDS) + 1).otherwise(len(KINDS)).alias("k"), "stop", F.when(F.col("gone"), "remove").otherwise("general").alias("kind"), "value")
    extra = free.groupBy("row").agg(F.collect_list(span).alias("extra"))
    both = base.join(extra, "row", "left")
    return both.select("doc_id", "text", F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "extra"))).alias("spans"), "base")


def coarser(value: Column) -> Column:
    """The class that stands for a generalised term: a number, a code of letters and digits, a name, or a word."""
    return (
        F.when(~value.rlike(r"\p{L}"), "[number]")
        .when(value.rlike(r"\p{N}"), "[code]")
        .when(value.rlike(r"^\p{Lu}"), "[name]")
        .otherwise("[word]")
    )


def sanitise(text: Column, spans: Column) -> Column:
    """`text` with every span replaced: base spans by their kind in brackets, "general" ones by their class, "remove" ones by nothing.

    A span that begins inside the one before it is passed over. Null text stays null.
    """
    add = lambda at, s: F.when(s["start"] < at, at).otherwise(s["stop"])
    new = lambda s: F.when(s["kind"] == "remove", "").when(s["kind"] == "general", coarser(s["value"])).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
    put = lambda at, s: F.struct(at.alias("at"), s["start"].alias("start"), s["stop"].alias("stop"), new(s).alias("new"))
    every = _running(spans, "struct<start:int,k:int,stop:int,kind:string,value:string>", F.lit(0), add, put, "struct<at:int,start:int,stop:int,new:string>")

    def of(kept: Column) -> Column:
        parts = F.transform(kept, lambda s: F.concat(F.substring(text, s["at"] + 1, s["start"] - s["at"]), s["new"]))
        tail = F.when(F.size(kept) > 0, F.element_at(kept, -1)["stop"]).otherwise(0)
        return F.concat(F.array_join(parts, ""), F.substring(text, tail + 1, F.char_length(text)))

    return _bound(F.filter(every, lambda s: s["start"] >= s["at"]), of)


def query(spark, sf_dir):
    found = find_spans(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), F.sha2(sanitise(F.col("text"), F.col("spans")), 256).alias("sanitised_sha256"))
