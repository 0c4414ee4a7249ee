"""Template decontamination against a plain Python version, re-parameterised
questions and awkward rows."""

import re
from collections import defaultdict

import pytest

import __spark_entry__ as E
from ledgerlens.llm import decontam as d
from tests.conftest import SF001


def codes(tokens, names):
    num = lambda t: t[0].isdigit() or t.lower() in d.NUMBER_WORDS
    out = []
    for i, t in enumerate(tokens):
        if num(t):
            out.append("<num>")
        elif t.lower() in d.UNIT_WORDS and i and num(tokens[i - 1]):
            out.append("<unit>")
        else:
            out.append("<name>" if names and t != t.lower() else t.lower())
    return out


def brute(docs, items, run=12, least=5):
    """All shifts of every document against every item, token by token."""
    split = lambda t: re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+", t or "")
    out = {}
    for item, text in items:
        it = split(text)
        need = min(run, len(it))
        if len(it) < least:
            continue
        p, n = codes(it, False), codes(it, True)
        w = max(least, need - 2)
        keys = {tuple(c[k:k + w]) for c in (p, n) for k in range(len(it) - w + 1)
                if sum(x[0] != "<" for x in c[k:k + w]) >= least}
        for doc, body in docs:
            dt = split(body)
            dp, dn = codes(dt, False), codes(dt, True)
            at = defaultdict(set)
            for c, d2 in ((p, dp), (n, dn)):
                where = defaultdict(list)
                for k in range(len(dt) - w + 1):
                    where[tuple(d2[k:k + w])].append(k)
                for k in range(len(it) - w + 1):
                    if tuple(c[k:k + w]) in keys:
                        for q in where[tuple(c[k:k + w])]:
                            at[q - k].add(k)
            for shift in at:
                ok = [0 <= i + shift < len(dt) and (p[i] == dp[i + shift] or n[i] == dn[i + shift] == "<name>") for i in range(len(it))]
                value = lambda i: (it[i].lower(), dt[i + shift].lower()) if n[i][0] == "<" else None
                size, end = part(ok, value, need, run)
                if size:
                    old = out.get((doc, item), (0, True))
                    differ = any(v and v[0] != v[1] for v in map(value, range(end - size, end)))
                    out[doc, item] = (max(old[0], size), old[1] and differ)
    return out


def part(ok, value, need, run):
    """(size, end) of what counts at one shift: the longest stretch that agrees, if
    its values map one to one, else the longest consistent part."""
    stretches, start = [], None
    for i, x in enumerate([*ok, False]):
        if x and start is None:
            start = i
        elif not x and start is not None:
            stretches.append((start, i))
            start = None

    def one_to_one(a, b):
        pairs = {value(i) for i in range(a, b)} - {None}
        return len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)
    a, b = max(stretches, key=lambda s: (s[1] - s[0], -s[0]), default=(0, 0))
    if b - a < need:
        return 0, 0
    if one_to_one(a, b):
        return b - a, b
    best = (0, 0)
    for lo, hi in stretches:
        for a in range(lo, hi):
            for b in range(a + 1, hi + 1):
                same = all(v is None or v[0] == v[1] for v in map(value, range(a, b)))
                enough = b - a >= 2 * run or (a, b) == (lo, hi) and b - a >= need
                if (enough and one_to_one(a, b)) or (same and b - a >= run + 1):
                    best = max(best, (b - a, -b))
    return best[0], -best[1]


def oracle(docs, items):
    """The registered SQL on small tables."""
    import duckdb
    import pandas as pd
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    return {(r[0], r[1]): (r[2], r[3]) for r in con.execute(E.oracle_sql()["op3_decontamination"]).fetchall()}


def found(df):
    return {(r["doc_id"], r["item_id"]): (r["n_tokens"], r["changed"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF001}/{t}.parquet").select(k, "text").collect()]
                   for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = found(E.queries()["op3_decontamination"](spark, SF001))
    assert got and got == brute(docs, items)


ITEMS = [(1, "If Anna buys 12 apples for 3 dollars each and then sells 12 pears to Boris how much money does Anna have "
             "when she pays Boris 5 dollars for the basket"),
         (2, "short words only make these tokens here"), (3, None), (None, "never used because it has no id at all"),
         (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15")]
Q = ITEMS[0][1]
DOCS = [(1, "Intro text. " + Q + " and an ending."), (2, Q.upper()),
        (3, "so " + Q.replace("12", "40").replace("Anna", "Carla").replace("dollars", "euros") + " then"),
        (4, Q.replace("12 pears", "13 pears").replace("Anna have", "Boris have").replace("Boris how", "Anna how")),
        (5, "nothing to see " * 30), (6, ""), (7, None), (None, "xx " + Q), (8, "9 " * 40),
        (9, "we say short words only make these tokens here again"), (1, "Intro text. " + Q + " and an ending.")]


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.createDataFrame([(i, t, "c") for i, t in DOCS], "doc_id long, text string, item_id string"),
            spark.createDataFrame(ITEMS, "item_id long, text string"))


def test_reparameterised_questions_and_odd_rows(spark, tables):
    docs, items = tables
    got = found(d.contaminated(docs, items))
    assert got[1, 1][1] is False and got[3, 1][1] is True and got[None, 1][1] is False
    assert (2, 1) in got and (4, 1) not in got and (9, 2) in got
    assert {k[0] for k in got} == {1, 2, 3, 9, None}
    want = brute(dict(DOCS).items(), [x for x in ITEMS if x[0] is not None])
    assert got == want


def test_decontaminate_and_empty_tables(spark, tables):
    docs, items = tables
    kept = d.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7, 8]
    assert d.contaminated(docs.limit(0), items).count() == 0
    assert d.contaminated(docs, items.limit(0)).count() == 0
    assert d.decontaminate(docs, items.limit(0)).count() == len(DOCS)


def test_short_and_number_rich_passages_at_every_offset(spark):
    items = [(1, "How many minutes are in 3 hours"), (2, "so 7 and 8 then 9 with ten apples were left over")]
    docs = [(100 * k + n, "w " * n + text + " end") for k, text in items for n in range(4)]
    got = found(d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id long, text string")))
    assert set(got) == {(100 * k + n, k) for k, _ in items for n in range(4)}
    assert got == brute(docs, items) == oracle(docs, items)


def test_a_conflicting_value_does_not_void_a_long_copy(spark):
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu") for b in ("ra", "se", "ti", "vo", "zu")]
    item = " ".join(words[:9] + ["12"] + words[9:18] + ["12"] + words[18:] + words[::-1])
    second = item.rindex("12")
    quote = item.split()[:16]
    docs = [(1, item[:second] + "13" + item[second + 2:]), (2, " ".join(quote[:9] + ["12"] + quote[10:] + ["oh"])),
            (3, " ".join(words[:9] + ["40"] + words[9:18] + ["41"])), (4, " ".join(item.split()[4:19] + ["13"]))]
    got = found(d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame([(1, item)], "item_id long, text string")))
    assert got == {(1, 1): (42, True), (2, 1): (16, False), (4, 1): (15, False)}
    assert got == brute(docs, [(1, item)]) == oracle(docs, [(1, item)])


def test_conflicts_in_every_place(spark):
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ra", "se", "ti") for c in ("na", "bo", "ku")]
    item = " ".join(f"{w} {i % 4}" if i % 3 == 0 else w for i, w in enumerate(words))
    tokens = item.split()
    docs = [(0, "filler " * 300 + item + " filler" * 10)]
    for i, t in enumerate(tokens):
        if t.isdigit():
            docs.append((i, " ".join([*tokens[:i], "9", *tokens[i + 1:]])))
            docs.append((1000 + i, " ".join([*tokens[max(0, i - 13):i], "9", *tokens[i + 1:i + 14]])))
            docs.append((2000 + i, " ".join(["77" if x == t else x for x in tokens])))
    got = found(d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame([(1, item)], "item_id long, text string")))
    assert got == brute(docs, [(1, item)]) == oracle(docs, [(1, item)])
    assert got[0, 1] == (len(tokens), False) and len({v for v in got.values()}) > 6
