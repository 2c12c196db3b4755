"""Mixing, sharding and redirects against plain Python or SQL, row by row."""

import math
import random
import re

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from deskmart.llm import expected, feistel_shards, mixing, queries, redirects
from deskmart.llm.common import KEY, text_key

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
M64 = (1 << 64) - 1


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)


def corpus(seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choices(["a", "bb", "ccc"], k=rng.randrange(0, 40))), f"s{min(rng.randrange(9), rng.randrange(9))}")
            for i in range(400)]
    return rows + [(500, None, "s1"), (None, "x y z", None), (None, "x y z", None), (7, rows[7][1], rows[7][2]), (501, "", "empty"), (502, " \n", "s0")]


def finish(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def feistel(value, n, seed):
    half = max(1, math.ceil(math.log2(max(2, n)) / 2))
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for k in range(1, feistel_shards.ROUNDS + 1):
            left, right = right, left ^ (finish(right ^ finish((k * 0x9E3779B97F4A7C15 & M64) ^ seed)) & mask)
        value = left << half | right
        if value < n:
            return value


def test_shards_match_a_plain_permutation(spark):
    rows = corpus(1)
    df = documents(spark, rows)
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long")
    bins = 16  # the least number; hashes come from Spark, all else from here
    keyed = df.select("doc_id", *text_key(), size.alias("size")).withColumn(
        "bin", F.pmod(F.xxhash64(F.lit(11), "doc_id", *KEY, "size"), F.lit(bins))).collect()
    order = sorted(keyed, key=lambda r: (r["bin"], r["doc_id"] is not None, r["doc_id"] or 0, r["key_a"], r["key_b"], r["size"]))
    n = len(rows)
    want = sorted((str(r["doc_id"]), r["size"], feistel(i, n, 20_240) % 16, feistel(i, n, 20_240) // 16) for i, r in enumerate(order))
    for parts in (1, 7):
        got = feistel_shards.assign_shards(df.repartition(parts)).collect()
        assert sorted((str(r["doc_id"]), r["size"], r["shard"], r["slot"]) for r in got) == want


def test_mix_matches_a_plain_walk(spark):
    rows = corpus(2)
    df = documents(spark, rows)
    word = re.compile(mixing.WORD)
    places = {}
    hashed = df.select("doc_id", "source", *text_key(), *(mixing.place(F.lit(e).cast("long"), 4).alias(f"p{e}") for e in range(4))).distinct()
    for r in hashed.collect():
        for e in range(4):
            places[r["doc_id"], r["source"] or "", r["key_a"], e] = r[f"p{e}"]
    keys = {(r["doc_id"], r["text"]): r["key_a"] for r in df.select("doc_id", "text", *text_key()).collect()}
    groups = {}
    for i, t, s in rows:
        k = (s or "", i, keys[i, t])
        n, c = groups.get(k, (0, 0))
        groups[k] = (len(word.findall(t or "")), c + 1)
    tokens = {}
    for (s, *_), (n, c) in groups.items():
        tokens[s] = tokens.get(s, 0) + n * c
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}

    def most_over_fewest(a):
        repeats = [p ** (a - 1) for p in share.values()]
        return max(repeats) / min(repeats)

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if most_over_fewest(middle) <= 1.5 else (middle, high)
    scale = sum(p ** high for p in share.values())
    whole = total * scale / min(p ** (high - 1) for p in share.values())
    want = []
    for s in {k[0] for k in groups}:
        own = [(k, *v) for k, v in groups.items() if k[0] == s]
        if s not in tokens:
            want += [(s, k[1], 0, 0) for k, _, c in own for _ in range(c)]
            continue
        budget, at, epoch = round(share[s] ** high / scale * whole), 0, 0
        while at < budget:
            for k, n, c in sorted(own, key=lambda x: (places[x[0][1], s, x[0][2], epoch], x[0][1] is not None, x[0][1] or 0, x[0][2])):
                if at + n * c <= budget:
                    want += [(s, k[1], epoch, min(at * 64 // budget, 63))] * c
                at += n * c
            epoch += 1
    got = [(r["source"], r["doc_id"], r["epoch"], r["block"]) for r in mixing.mix_schedule(df.repartition(3)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


TAGS = (
    '<link rel="canonical" href="{0}">', "<LINK href='{0}' rel=canonical>", '<link rel="alternate canonical" href={0} >', '<link data-rel="canonical" href="{0}">',
    '<meta http-equiv="refresh" content="0; url={0}">', "<meta content='5;URL={0}' http-equiv=refresh>", '<meta name="refresh" content="0; url={0}">',
    '<link rel="stylesheet" href="{0}">', '<link rel=canonical>', '<a href="{0}">')
TARGETS = ("http://example.org/en/12", "https://a.fr.com/fr/x", "//www.example.org/es/q", "/de/y?a=1&amp;b=2", "../de/./z", "./", "..", "../../../../es/",
           "?page=2", "#top", "mailto:x@y", "", "x.html#f", "http://b.com/de/", "/..")
URLS = ("http://c.net/a/b/c.html", "https://sub.example.org/en/3?x=1#y", "http://www.d.com/", "http://d.com", "noscheme/x", "ftp://e.net/de/f", "http://m.g.com:80/fr/h/",
        "http://q.net/a?utm_source=z", "http://q.net/a", None)


def test_declared_targets_match_sql(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice(URLS) if k % 3 else f"http://h{k}.net/p/{k}", "<html>" + "".join(
        rng.choice(TAGS).format(rng.choice(TARGETS)) for _ in range(rng.randrange(3))) if k % 11 else None) for k in range(400)]
    # a page with a canonical link to itself and a refresh to a blocked address is blocked
    rows.append((900, "http://self.net/x", '<link rel="canonical" href="http://self.net/x"><meta http-equiv="refresh" content="0;url=http://example.org/es/1">'))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = redirects.judge_pages(pages, queries.URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [r[0] for r in rows], "url": pa.array([r[1] for r in rows], pa.string()), "html": pa.array([r[2] for r in rows], pa.string())}))
    want = con.execute(expected.URL_VERDICTS).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    verdicts = {r["page_id"]: (r["rule"], r["verdict"]) for r in got}
    assert verdicts[900] == (None, "block")


def test_long_html_takes_linear_time(spark):
    html = "<link " * 100_000 + '<link rel="canonical" href="http://example.org/es/1">' + "<meta " * 50_000
    pages = spark.createDataFrame([(1, "http://z.net/", html), (2, "http://y.net/" + "../" * 50_000, "x" * 300_000)], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in redirects.judge_pages(pages, queries.URL_RULES).collect()}
    assert set(got) == {1, 2}
