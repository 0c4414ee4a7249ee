"""Benchmark decontamination by template canonicalisation, all native.

Texts become word and number tokens. Numbers, units after numbers and
capitalised words are replaced by typed placeholders, and windows of the
resulting templates are hash-joined with those of the benchmark. A pair that
meets is compared token by token at its shift: a long enough stretch must agree
and the values behind its placeholders must map one to one, so a question with
other numbers or names is caught and a chance template is not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_table

# The words that count as numbers and as units.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million billion half dozen").split()
UNIT_WORDS = ("mm cm m km mg g kg lb lbs oz ml l inch inches foot feet yard yards mile miles meter meters metre metres "
              "kilometer kilometers kilometre kilometres gram grams kilogram kilograms pound pounds ton tons liter "
              "liters litre litres second seconds minute minutes hour hours day days week weeks month months year years "
              "cent cents dollar dollars euro euros percent degree degrees mph kmh watt watts volt volts").split()
TOKEN = r"\p{N}+(?:[.,]\p{N}+)*|\p{L}+"
# the codes of the placeholders
NUM, UNIT, NAME = 1, 2, 3
#: Benchmark windows up to this many are broadcast; beyond it the join shuffles.
BROADCAST_WINDOWS = 500_000


def _is_number(low: Column) -> Column:
    # the ASCII digits are the characters from "0" to the one before ":"
    return ((low >= "0") & (low < ":")) | low.isin(NUMBER_WORDS)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a plain reference would be
    inlined into the lambdas below it and computed again for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def templates(tokens: Column) -> Column:
    """struct(p, n): the tokens as codes (hashes) with number and unit
    placeholders, and the same with capitalised words replaced as well.
    ``tokens`` must be a bound value (see _let)."""
    def plain(low: Column) -> Column:
        num, unit = (F.lit(x).cast("long") for x in (NUM, UNIT))
        after = lambda i: (i > 0) & _is_number(F.get(low, i - 1))
        # one lookup tells most words apart from the listed ones
        return F.transform(low, lambda t, i: F.when((t >= "0") & (t < ":"), num)
                           .when(~t.isin(NUMBER_WORDS + UNIT_WORDS), F.xxhash64(t))
                           .when(t.isin(NUMBER_WORDS), num).when(after(i), unit).otherwise(F.xxhash64(t)))

    def both(low: Column) -> Column:
        return _let(plain(low), lambda p: F.struct(p.alias("p"), F.transform(
            p, lambda c, i: F.when(F.get(tokens, i) != F.get(low, i), F.lit(NAME).cast("long")).otherwise(c)).alias("n")))
    return _let(F.transform(tokens, lambda t: F.lower(t)), both)


def _tokens(text_col: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN), F.lit(0))


def _spots(codes: Column, length: int) -> Column:
    """(pos, h) of every window of bound ``codes``; none where fewer tokens."""
    places = F.when(F.size(codes) >= length, F.sequence(F.lit(0), F.size(codes) - length))
    return F.transform(places, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice(codes, i + 1, F.lit(length))).alias("h")))


def document_windows(docs: DataFrame, key: list[Column], text_col: str, lengths: list[int]) -> DataFrame:
    """(key, pos, h): windows of both template forms of every text, for each
    length. Equal forms give equal hashes and then one row."""
    def spots(codes: Column) -> Column:
        none = F.array().cast("array<struct<pos:int,h:bigint>>")
        return F.concat(*[F.coalesce(_spots(codes, n), none) for n in lengths])
    found = _let(_let(_tokens(text_col), templates), lambda s: _let(s["p"], lambda p: _let(s["n"], lambda n: F.struct(
        spots(p).alias("p"), spots(n).alias("n")))))
    # both lists have the same places: keep the second's entry where it differs
    found = _let(found, lambda s: F.concat(s["p"], F.filter(s["n"], lambda x, i: x["h"] != F.get(s["p"], i)["h"])))
    return docs.select(*key, F.inline(found))


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, run: int, least: int) -> DataFrame:
    """(item, need, len, at, h): windows of both forms with ``least`` literal
    tokens. An item needs a stretch of ``run`` tokens (all of a shorter item);
    its windows are two shorter. Windows with fewer literal tokens are dropped
    one by one, so documents have theirs at every place."""
    items = benchmark.where(F.col(item_col).isNotNull()) \
        .select(F.col(item_col).alias("item"), _let(_tokens(text_col), templates).alias("f")) \
        .select("item", F.explode(F.array("f.p", "f.n")).alias("codes")).where(F.size("codes") >= least)
    items = items.withColumn("need", F.least(F.size("codes"), F.lit(run))) \
        .withColumn("len", F.greatest(F.lit(least), F.col("need") - 2))
    cut = items.select("item", "need", "len", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("codes") - F.col("len")), lambda i: F.slice("codes", i + 1, F.col("len")))).alias("at", "w"))
    literal = F.size(F.filter("w", lambda c: (c != NUM) & (c != UNIT) & (c != NAME)))
    return cut.where(literal >= least).select("item", "need", "len", "at", F.xxhash64("w").alias("h")).distinct()


def _longest_part(tokens: Column, need: Column, run: int) -> Column:
    """struct(best, end): the longest part of the stretches that agree whose
    values map one to one; best is 0 where none counts. A whole stretch counts
    from ``need`` tokens, a part of one with conflicting values from 2 ``run``,
    or from ``run`` + 1 tokens of which no value differs."""
    def bounds(t: Column) -> Column:
        """Where a part that ends with ``t`` may start at the earliest."""
        clash = F.filter(tokens, lambda u: u["slot"] & u["ok"] & (u["i"] < t["i"]) & ((u["a"] == t["a"]) != (u["b"] == t["b"])))
        after = t["i"] + 1
        return F.struct(t["i"].alias("i"), F.when(~t["ok"], after).otherwise(0).alias("whole"),
                        F.when(~t["ok"], after).when(t["slot"], F.coalesce(F.array_max(clash["i"]) + 1, F.lit(0))).otherwise(0).alias("part"),
                        F.when(~t["ok"] | (t["slot"] & (t["a"] != t["b"])), after).otherwise(0).alias("same"),
                        (~F.coalesce(F.get(tokens, after)["ok"], F.lit(False))).alias("last"))

    def step(s: Column, x: Column) -> Column:
        def best(n: Column) -> Column:
            end = x["i"] + 1
            part, same = end - n["part"], end - n["same"]
            counts = (part >= 2 * run) | (x["last"] & (n["part"] == n["whole"]) & (part >= need))
            size = F.when(counts, part).when(same >= run + 1, same).otherwise(0)
            return F.struct(n["whole"].alias("whole"), n["part"].alias("part"), n["same"].alias("same"),
                            F.greatest(s["best"], size).alias("best"), F.when(size > s["best"], end).otherwise(s["end"]).alias("end"))
        return _let(F.struct(*[F.greatest(s[k], x[k]).alias(k) for k in ("whole", "part", "same")]), best)
    zero = F.struct(*[F.lit(0).alias(k) for k in ("whole", "part", "same", "best", "end")])
    return F.aggregate(F.transform(tokens, bounds), zero, step, lambda s: F.struct(s["best"].alias("best"), s["end"].alias("end")))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", run: int = 12, least: int = 5) -> DataFrame:
    """(doc_id, item_id, n_tokens, changed) for every document that holds a
    benchmark passage.

    A document matches an item if, at one shift, at least ``run`` template
    tokens in a row agree (all tokens of a shorter item), a window of them has
    ``least`` literal tokens, and the values behind the placeholders of the
    longest such stretch map one to one. Of stretches where they don't, the
    longest consistent part counts from twice ``run`` tokens, or from ``run`` + 1
    tokens copied with all values. A token agrees if its code does, or if
    both are capitalised. ``n_tokens`` is the longest stretch or part, ``changed`` tells
    whether some value differs at every matching shift. Null and empty texts and
    items hold nothing; a null item id is ignored; rows of one id match as one
    document; items with equal texts each match; items under ``least`` tokens
    never do. A text of any length is one row of windows, dealt out as they are
    made; further columns are ignored. Empty tables give no rows."""
    wins = shared_table(benchmark_windows(benchmark, item_col, item_text_col, run, least), "bench-windows")
    # at most ``run`` rows
    lengths = [r["len"] for r in wins.select("len").distinct().orderBy("len").collect()]
    if not lengths:
        schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id " \
                 f"{benchmark.schema[item_col].dataType.simpleString()}, n_tokens long, changed boolean"
        return docs.sparkSession.createDataFrame([], schema)
    keys = [F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th")]
    if wins.count() <= BROADCAST_WINDOWS:
        wins = F.broadcast(wins)
    met = document_windows(docs, keys, text_col, lengths).join(wins, "h") \
        .select("doc", "th", "item", "need", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    met = shared_table(met, "decontam-met")
    texts = docs.select(*keys, F.col(text_col).alias("body")) \
        .select(F.col("doc").alias("d2"), F.col("th").alias("t2"), "body")
    # only texts that met an item are split again
    found = texts.join(met.select("doc", "th").distinct(),
                       F.col("d2").eqNullSafe(F.col("doc")) & (F.col("t2") == F.col("th")), "left_semi") \
        .groupBy("d2", "t2").agg(F.first("body").alias("body")) \
        .select("d2", "t2", _let(_tokens("body"), lambda t: F.struct(t.alias("t"), templates(t).alias("c"))).alias("dt"))
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("item"),
        _let(_tokens(item_text_col), lambda t: F.struct(t.alias("t"), templates(t).alias("c"))).alias("it"))
    both = met.join(shared_table(found, "decontam-texts"), F.col("doc").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2"))) \
        .join(items, "item")

    def token(c: Column, i: Column) -> Column:
        j = F.when(i + F.col("shift") >= 0, i + F.col("shift"))
        mine, named = F.get("dt.c.p", j), F.get("dt.c.n", j)
        return F.struct(i.alias("i"), F.coalesce((c == mine) | ((F.get("it.c.n", i) == NAME) & (named == NAME)), F.lit(False))
                        .alias("ok"), F.get("it.c.n", i).isin(NUM, UNIT, NAME).alias("slot"),
                        F.lower(F.get("it.t", i)).alias("a"), F.lower(F.get("dt.t", j)).alias("b"))
    both = both.withColumn("tokens", F.transform("it.c.p", token))
    # the longest stretch that agrees: its length and its end; the first of equals
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("end"))
    step = lambda s, x: _let(F.when(x["ok"], s["now"] + 1).otherwise(0), lambda n: F.struct(
        n.alias("now"), F.greatest(s["best"], n).alias("best"), F.when(n > s["best"], x["i"] + 1).otherwise(s["end"]).alias("end")))
    both = both.withColumn("s", F.aggregate("tokens", zero, step)).where(F.col("s.best") >= F.col("need"))

    def slots(best: Column, end: Column) -> Column:
        return F.filter("tokens", lambda x: x["slot"] & (x["i"] < end) & (x["i"] >= end - best))

    both = both.withColumn("slots", slots(F.col("s.best"), F.col("s.end")))
    pairs = F.size(F.array_distinct(F.transform("slots", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))))
    fits = (pairs == F.size(F.array_distinct("slots.a"))) & (pairs == F.size(F.array_distinct("slots.b")))
    # only where it does not fit: the longest consistent part
    both = both.withColumn("s", F.when(fits, F.struct(F.col("s.best").alias("best"), F.col("s.end").alias("end")))
                           .otherwise(_longest_part(F.col("tokens"), F.col("need"), run))).where(F.col("s.best") > 0)
    changed = F.exists(slots(F.col("s.best"), F.col("s.end")), lambda x: x["a"] != x["b"])
    return both.groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")) \
        .agg(F.max("s.best").cast("long").alias("n_tokens"), F.min(changed).alias("changed"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """The rows of ``docs`` whose id is not contaminated, all columns; rows
    without an id go where one of them matches."""
    bad = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["gone"]), "left_anti")
