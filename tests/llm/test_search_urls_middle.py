"""Lexical search, URL rules and fill-in-the-middle against brute force."""

import hashlib
import itertools
import math
import re
from collections import Counter
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from citymarts.llm import fill_middle, lexical_search, queries, url_rules
from citymarts.llm.common import prepare, table

SF = "/root/testdata/sf0.001"
LONG = "long words " * 20_000 + "end"


@pytest.fixture(scope="module")
def docs(spark):
    """NULLs, empty and long texts, repeated rows and ids, ties, clashing extra columns."""
    prepare(spark)
    rows = [
        (1, "The cat sat on the mat."), (2, "the CAT the cat"), (2, "the CAT the cat"), (3, "Straße ÉÀ é x9-y"), (4, ""), (5, None), (6, "  \n\t "),
        (7, LONG), (8, "cat"), (9, "cat"), (None, "cat"), (None, None), (10, "a <P> b"), (11, "one two  three\n\nfour "), (12, "日本語 𝒳𝒴 x\x1cy\u3000z"),
        (13, " lead"), (14, "tail\n"), (15, "$1 \\E \\Q $2 {3}"), (16, "<S"), (17, "<P <S <M > >"),
    ]
    rows += [(100 + i, f"word{i % 7} cat <x> line{i}\nmore  words {i}" * (1 + i % 3)) for i in range(60)]
    return spark.createDataFrame([(i, t, 1, "c", 2, 0) for i, t in rows], "doc_id long, text string, n int, form string, rank int, _text int")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# -- lexical search --------------------------------------------------------------------------------------------------


def brute_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_rank(rows, items, top):
    terms = [Counter(brute_terms(t)) for _, t in rows]
    n_docs, n_terms = sum(bool(t) for t in terms), sum(sum(t.values()) for t in terms)
    df = Counter(t for c in terms for t in c)
    out = []
    for item, text in set(items):
        found = []
        for (doc, _), c in zip(rows, terms):
            m = 10 + 90 * sum(c.values()) * n_docs // max(1, n_terms)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(brute_terms(text)) if c[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:top])]
    return Counter(out)


ITEMS = [
    (0, "the cat"), (1, "The cat sat, the mat"), (2, "straße é"), (3, ""), (4, None), (5, "words long end cat the"), (6, "nowhere"), (7, "word1 word2 word3 cat more"),
    (8, "word1 word2 word3 line4"), (8, "another text of item 8: cat"), (8, "word1 word2 word3 line4"), (None, "cat the"), (9, "日本語 𝒳𝒴 " + LONG),
]


@pytest.mark.parametrize("block_bytes", [lexical_search.BLOCK_BYTES, 100_000])
def test_ranking_equals_brute_force(spark, docs, rows, block_bytes):
    items = spark.createDataFrame([(i, t, "clash") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = lexical_search.rank_items(docs.repartition(5), items, 4, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == brute_rank(rows, ITEMS, 4)


def test_ranking_of_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    empty = [lexical_search.rank_items(docs.limit(0), items), lexical_search.rank_items(docs, items.limit(0)), lexical_search.rank_items(docs.where("text IS NULL"), items)]
    for df in empty:
        assert df.count() == 0 and dict(df.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_many_equal_scores_keep_the_smallest_ids(spark):
    docs = spark.range(0, 5000, 1, 9).select((4999 - F.col("id")).alias("doc_id"), F.lit("same text").alias("text"))
    docs = docs.unionByName(spark.range(5000).select((-F.col("id")).alias("doc_id"), F.lit("other").alias("text")))
    items = spark.createDataFrame([(1, "same"), (2, "text same")], "item_id long, text string")
    got = lexical_search.rank_items(docs, items).orderBy("item_id", "rank").collect()
    assert [r.doc_id for r in got] == [*range(10), *range(10)]


def test_windows_of_a_long_text(monkeypatch):
    whole = lexical_search.count_terms(LONG + " ÄÖ x")
    monkeypatch.setattr(lexical_search, "WINDOW", 7)
    assert lexical_search.count_terms(LONG + " ÄÖ x") == whole


def test_shared_nodes_add_up_to_every_item():
    items = [set("abcdef"), set("abcxyz"), set("abcdxy"), set("q"), set(), set("abcdefxyz")]
    terms, plan = lexical_search.share_terms(items)

    def leaves(k):
        return [k] if k < plan.leaves else [x for c in plan.pairs[k - plan.leaves] for x in leaves(c)]

    for item, row in zip(items, plan.rows):
        held = [x for k in row for x in leaves(k)]
        assert sorted(t for t, leaf in zip(terms, plan.leaf_of) if leaf in held) == sorted(item)
        assert len(held) == len(set(held))
    assert plan.pairs and all(a < plan.leaves + k and b < plan.leaves + k for k, (a, b) in enumerate(plan.pairs))
    adds = len(plan.pairs) + sum(map(len, plan.rows))
    assert adds < sum(map(len, items))


# -- URL rules ---------------------------------------------------------------------------------------------------------

RULES = queries.URL_RULES
URLS = [
    "http://a.example.org/en/1234", "https://example.org/en/2", "http://x.example.org/es/7?ref=1&page=2#top", "HTTP://WWW.EXAMPLE.ORG/es", "http://org",
    "http://org/", "http://notorg/x", "http://shop.example.com/fr/9", "http://shop.example.com/de/9", "http://shop.example.com/es/9", "http://b.example.net/es/9",
    "http://b.example.net/fr/9.html", "http://b.example.net/de/1", "no scheme", "", None, "://", "x://y://z/p?q#f", "http://h?x=1/2", "http://h#f/g", "http://É.Com/fr/É",
    "http://example.org:80/es/", "http://spam.example.net/casino/win", "http://a.example.org/casino/win?" + "&".join(f"k{i}=v" for i in range(30)),
    "http://b.example.com/de/casino/" + "x" * 50_000, "http://.org/", "http://a..com/de/", "http://a.org/en/\n1",
]


def brute_parts(url):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    rest = rest[len(host) + len(path) :]
    query = rest[1:].partition("#")[0] if rest.startswith("?") else ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path, query


def brute_judged(host, path):
    fits = [
        (len(r), v, r) for v, r in RULES
        if ("." + host).endswith("." + r.partition("/")[0]) and path.startswith("/" + r.partition("/")[2])
    ]
    return max(fits)[1:] if fits else (None, None)


def brute_tokens(host, path, query):
    return {f"h:{x}" for x in host.split(".") if x} | {f"p:{x}" for x in path.split("/") if x} | {f"q:{x.partition('=')[0]}" for x in query.split("&") if x.partition("=")[0]}


def brute_filter(urls, support, confidence):
    """Counts every combination of up to all frequent tokens."""
    parts = [brute_parts(u) for u in urls]
    known = [(brute_tokens(*p), brute_judged(*p[:2])[0]) for p in parts]
    labelled = [(t, v) for t, v in known if v]
    least = max(1, math.ceil(support * len(labelled)))
    frequent = {t for t, c in Counter(x for t, _ in labelled for x in t).items() if c >= least}
    seen, judged = Counter(), Counter()
    for t, v in labelled:
        t = sorted(t & frequent)
        for k in range(1, len(t) + 1):
            for c in itertools.combinations(t, k):
                seen[c] += 1
                judged[c, v] += 1
    out = []
    for url, p, (t, _) in zip(urls, parts, known):
        verdict, rule = brute_judged(*p[:2])
        if not verdict:
            held = [(Fraction(n, seen[c]), n, v == "block", v) for (c, v), n in judged.items() if set(c) <= t and n >= least and n >= confidence * seen[c]]
            verdict = max(held)[3] if held else "allow"
        out.append((p[0], p[1], rule, verdict))
    return out


@pytest.mark.parametrize("support", [0.01, 0.1, 0.4])
def test_url_verdicts_equal_brute_force(spark, support):
    urls = [u for u in URLS if not u or u.count("&") < 9] + [f"http://w{i % 3}.example.{('org', 'com', 'net')[i % 3]}/{('de', 'es', 'fr', 'en')[i % 4]}/{i}?p={i}" for i in range(60)]
    urls += ["http://hot.example.org/es/a/b"] * 40
    pages = spark.createDataFrame([(i, u, "x", "clash", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, tokens string, rule int")
    got = url_rules.filter_urls(pages.repartition(3), rules=RULES, min_support=support).orderBy("page_id").collect()
    assert [r.page_id for r in got] == list(range(len(urls)))
    assert [(r["host"], r.path, r["rule"], r.verdict) for r in got] == brute_filter(urls, support, url_rules.MIN_CONFIDENCE)


def test_url_rules_on_odd_tables(spark):
    pages = spark.createDataFrame([(1, URLS[0]), (1, URLS[0]), (None, URLS[7]), (None, None), *((9, u) for u in URLS)], "page_id long, url string")
    got = url_rules.filter_urls(pages, rules=RULES)
    assert got.count() == 4 + len(URLS) and got.where("verdict IS NULL OR host IS NULL OR path IS NULL").count() == 0
    assert url_rules.filter_urls(pages.limit(0), rules=RULES).count() == 0
    alone = url_rules.filter_urls(pages, rules=[], otherwise="block")  # nothing labelled: nothing mined
    assert {r.verdict for r in alone.collect()} == {"block"}


def test_mined_combination_decides_beyond_the_rules(spark):
    """Neither token alone is enough; together they are."""
    labelled = [("http://a.net/win/x", "allow")] * 5 + [("http://casino.net/x", "allow")] * 5 + [("http://casino.net/win", "block")] * 6
    labelled = spark.createDataFrame([(u, v, i) for i, (u, v) in enumerate(labelled)], "url string, verdict string, extra int")
    pages = spark.createDataFrame([(1, "http://casino.org/win/2"), (2, "http://casino.org/2"), (3, "http://b.org/win")], "page_id long, url string")
    got = url_rules.filter_urls(pages, labelled=labelled, min_support=0.2, min_confidence=0.9).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "allow", 3: "allow"}


# -- fill in the middle ------------------------------------------------------------------------------------------------


def brute_middle(doc, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc, len(units), "plain", None, None, None, text
    if h[3] % 100 < 80:
        return doc, len(units), "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}"
    return doc, len(units), "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}"


def test_middles_equal_brute_force(docs, rows):
    keyed = [(i * 31 + k, t) for i, (_, t) in enumerate(rows) for k in range(6)] + rows  # every text under several draws
    frame = docs.sparkSession.createDataFrame([(i, t, 1, "x", "y") for i, t in keyed], "doc_id long, text string, n int, form string, prefix string")
    made = fill_middle.fill_in_middle(frame.repartition(3))
    got = Counter(tuple(r) for r in made.collect())
    assert got == Counter(brute_middle(*r) for r in keyed)
    assert {k[2] for k in got} == {"plain", "spm", "psm"}
    back = made.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert Counter(tuple(r) for r in back.collect()) == Counter((i, t or "") for i, t in keyed)
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_middles_with_other_marks(spark):
    marks = ("$1<", "\\M.", "[x]")
    frame = spark.createDataFrame([(i, f"a$1 b\\ c. [x {i}") for i in range(80)], "doc_id long, text string")
    made = fill_middle.fill_in_middle(frame, marks=marks, plain_from=100)
    back = made.select("doc_id", "form", fill_middle.restored(F.col("output"), F.col("form"), marks).alias("text"))
    assert {(r.doc_id, r.text) for r in back.collect()} == {(i, f"a$1 b\\ c. [x {i}") for i in range(80)}
    assert {r.form for r in back.collect()} == {"spm", "psm"}


# -- registered queries ------------------------------------------------------------------------------------------------


def test_registered_queries_equal_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    assert Counter(tuple(r) for r in queries.op11_lexical_search(spark, SF).collect()) == brute_rank(docs, items, 10)
    pages = [tuple(r) for r in table(spark, SF, "pages").select("page_id", "url").orderBy("page_id").collect()]
    got = [(r["host"], r.path, r["rule"], r.verdict) for r in queries.op12_url_rules(spark, SF).orderBy("page_id").collect()]
    assert got == brute_filter([u for _, u in pages], url_rules.MIN_SUPPORT, url_rules.MIN_CONFIDENCE)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    chars = lambda t: None if t is None else len(t)
    want = Counter((d, n, form, chars(p), chars(m), sha(out), sha(t or "")) for (d, t) in docs for _, n, form, p, m, _, out in [brute_middle(d, t)])
    assert Counter(tuple(r) for r in queries.op13_fill_in_middle(spark, SF).collect()) == want


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_registered_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want.fetchall())


@pytest.mark.parametrize("name", ["op12_url_rules", "op13_fill_in_middle"])
def test_native_plans_hold_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search(r"Python|InArrow|InPandas|ExistingRDD|Cartesian|NestedLoop", plan)
