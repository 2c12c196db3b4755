"""Whitening, fill-in-middle frames and personal data against brute force, and their results for odd rows."""

import hashlib
import random
import re
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deskmart.llm import disclosure, expected, fim_frames, secret_ledger, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (None, "some words here"), (None, None), (3, "same text"), (3, "same text"),
       (4, "long " * 50_000), (5, "\n\n"), (6, "x" * 200_000), (7, "7" * 100_000), (8, "<P> in text\nx")]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def from_sql(rows, sql):
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]}))
    return sorted(con.execute(sql).fetchall(), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# whitening

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def whitened(spark, x, parts=3):
    df = vectors(spark, [(i, [float(v) for v in r]) for i, r in enumerate(x)]).repartition(parts)
    rows = sorted(whitening.whiten(df).collect(), key=lambda r: (r["vec_id"], r["component"]))
    return rows, np.array([r["whitened"] for r in rows]).reshape(len(x), -1)


def test_whitening_matches_dense_eigenvectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 3
    rows, got = whitened(spark, x)
    whole = np.floor(1024 * x).astype(np.int64) + 100_000
    n = len(x)
    e, u = np.linalg.eigh(np.cov(whole.T, bias=True))
    e, u = e[::-1], u[:, ::-1]
    want = (whole - whole.mean(axis=0)) @ u[:, :8] / np.sqrt(e[:8])
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got * sign - want).max() < 1e-9
    assert np.allclose([r["explained"] for r in rows[:8]], e[:8] / e.sum(), rtol=1e-10)
    deviation = ((n * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    assert [r["deviation"] for r in rows[::8]] == deviation.tolist()
    assert {r["n"] for r in rows} == {n} and rows[0]["identity_error"] < 1e-10
    again = whitened(spark, x, parts=7)[1]  # sums are whole numbers, so partitions change nothing
    assert np.array_equal(got, again)


def test_whitening_of_low_rank_and_wide_values(spark):
    rng = np.random.default_rng(2)
    rows, got = whitened(spark, np.outer(rng.normal(size=40), [1.0, 2.0, 0.0]) * 1e6)
    assert 1 <= got.shape[1] <= 2 and abs(rows[0]["explained"] - 1) < 1e-9  # rounding down adds a little noise
    exact = rng.integers(-5, 5, size=(50, 1)) @ np.array([[1, 2, 0, -1]])
    assert whitened(spark, exact)[1].shape[1] == 1
    big = rng.normal(size=(60, 4)) * 1e9
    got = whitened(spark, big)[1]
    assert np.abs(np.cov(got.T, bias=True) - np.eye(4)).max() < 1e-9


def test_products_without_rounding():
    rng = np.random.default_rng(3)
    y = rng.integers(-2 ** 50, 2 ** 50, size=(20, 3))
    assert (whitening._products(y) == y.astype(object).T @ y.astype(object)).all()


def test_cholesky_and_jacobi_of_a_singular_matrix():
    rng = np.random.default_rng(4)
    half = rng.normal(size=(9, 5))
    factor, order = whitening.pivoted_cholesky(half @ half.T)
    assert factor.shape == (9, 5) and np.allclose(factor @ factor.T, (half @ half.T)[np.ix_(order, order)])
    assert np.allclose(np.triu(factor, 1), 0)
    values, vectors_ = whitening.eigen(half @ half.T)
    assert np.allclose(values, np.linalg.eigvalsh(half @ half.T)[::-1][:5])
    assert np.allclose(vectors_.T @ vectors_, np.eye(5))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0]), (None, [0.0, 1.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]),
            (6, [1.0, -inf]), (7, [1e30, 1.0]), (8, [1.0]), (9, [])]
    got = whitening.whiten(vectors(spark, rows).select("*", F.lit(1).alias("deviation"), F.lit(1).alias("at"))).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((str(i), c) for i in (1, 2, 2, None) for c in (1, 2))
    assert {r["n"] for r in got} == {4}
    for none in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        empty = whitening.whiten(vectors(spark, none))
        assert empty.collect() == [] and empty.columns == got[0].__fields__


# fill-in-middle

LINE = re.compile(r"[^\n]*\n|[^\n]+")


def test_fill_in_middle_matches_sql_at_every_frame_size(spark):
    rng = random.Random(1)
    alphabet = ["word ", "é", "漢字", "\n", "\n\n", "<", "P>", "<P", "😀 x\n", "tail", "\r\n"]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randrange(0, 60)))) for i in range(300)] + ODD
    rows += [(1000 + i, t) for i, t in enumerate(("\n", "a", "a\n", "\na", "<P>", "x<S", "<M>\n", "a\n" * 5))]
    want = from_sql(rows, expected.FILL_IN_MIDDLE)
    df = documents(spark, rows).withColumn("lines", F.lit(7)).withColumn("output", F.lit("x"))
    assert rows_of(fim_frames.transform_documents(df)) == want
    for size in (5, 16, 97):
        store = fim_frames.frame_store(df, size=size)
        outputs = fim_frames.fill_in_middle(store)
        assert rows_of(fim_frames.digests(outputs)) == want
    got = {(r["doc_id"], hashlib.sha256(r["output"].encode()).hexdigest()) for r in fim_frames.texts(outputs).collect()}
    assert got == {(r[0], r[5]) for r in want}
    assert fim_frames.transform_documents(df.limit(0)).collect() == []


def test_frames_are_independent_and_counted(spark):
    text = "".join(f"line {i} é\n" for i in range(3000)) + "end"
    row = fim_frames.frame_store(documents(spark, [(1, text)]), size=1000).first()
    pieces = [fim_frames._Codec().open(f) for f in row["frames"]]
    assert b"".join(pieces).decode() == text and max(map(len, pieces)) <= 1000 and len(pieces) > 30
    assert (row["lines"], row["chars"]) == (3001, len(text))
    for k, piece in enumerate(pieces):
        ahead = b"".join(pieces[:k]).decode()
        assert (row["lines_before"][k], row["chars_before"][k]) == (ahead.count("\n"), len(ahead))


def test_cuts_open_only_the_frames_that_hold_them():
    codec, opened = fim_frames._Codec(), []
    text = "".join(f"{i:05d}\n" for i in range(2000)).encode()
    frames = [codec.pack(p) for p in fim_frames._pieces(memoryview(text), 600)]
    before = [100 * k for k in range(len(frames))]
    whole = codec.open
    codec.open = lambda frame: opened.append(frame) or whole(frame)
    prefix, middle, suffix, _ = fim_frames._sections(codec, (150, 1250), 2000, before, frames)
    assert opened == [frames[1], frames[12]]
    joined = [b"".join(map(whole, part)) for part in (prefix, middle, suffix)]
    assert joined == [text[:150 * 6], text[150 * 6:1250 * 6], text[1250 * 6:]]


def test_rate_and_marks_are_parameters(spark):
    df = documents(spark, [(i, f"a{i}\nb\nc") for i in range(200)])
    marks = fim_frames.Marks("{pre}", "{suf}", "{mid}")
    out = fim_frames.texts(fim_frames.fill_in_middle(fim_frames.frame_store(df, marks), marks, seed="9", rate=50, spm=0)).collect()
    forms = [r["form"] for r in out]
    assert set(forms) == {"plain", "psm"} and 60 < forms.count("plain") < 140
    for r in out:
        if r["form"] == "psm":
            pre, rest = r["output"].removeprefix("{pre}").split("{suf}")
            suf, mid = rest.split("{mid}")
            assert pre + mid + suf == f"a{r['doc_id']}\nb\nc" and len(pre) == r["prefix_chars"] and len(mid) == r["middle_chars"]


# personal data

def planted():
    """Texts around protected values: terms that stand with one value only, its stem's relatives, copies, lists."""
    rng = random.Random(2)
    common = [f"word{i:03d}x" for i in range(300)]
    rows = [(i, " ".join(rng.choices(common, k=40))) for i in range(1200)]
    for i in range(6):     # zorblax always stands with the address, gremble also elsewhere, rare in two only
        rows.append((2000 + i, f"Zorblax, mail zed.{7}@corp.example.org now; gremble {'rareone' if i < 2 else ''} " + rng.choice(common)))
    rows += [(2100 + i, "zorbit zorba gremble here now") for i in range(9)]
    rows += [(2200, "qua 10.20.30.40 ab quay7")] * 4 + [(2210 + i, f"public mail info@site.example.com {common[i]}") for i in range(60)]
    many = " ".join(f"user{i}@list.example.net note{i:04d}y" for i in range(80))
    rows += [(2400 + i, many + f" v{i}") for i in range(4)]
    return rows


def test_disclosure_matches_sql(spark):
    rows = planted() + ODD
    rows += [(3000 + i, t) for i, t in enumerate((
        "a@b.com@c.org x.y@z.co.uk. _d@e.f@g", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.255", "4111 1111-1111 1111 4111111111111112",
        "+49 (30) 1234-5678 + 1 +1--2 +12 34 56 78 90 12 34 56", "4111111111111111" * 3, "1 2 3 4 5 6 7 8 9 0 1 2 3 4", "é@ü.de ok@ok.ok-", "+1+1 222 333 4444+"))]
    df = documents(spark, rows).withColumn("base", F.lit(1)).withColumn("term", F.lit("x")).repartition(5)
    got = rows_of(disclosure.find_disclosures(df))
    assert got == from_sql(rows, expected.PERSONAL_DATA)
    found = {r[0]: r[-1] for r in got if r[0] is not None}
    assert "general:0:7,email:14:36" == found[2005]
    assert "general" not in found[2100] and found[2100] == "" and found[1] == ""
    assert "removed:0:3" in found[2200] and "general:19:24" not in found[2200]
    assert "general" not in found[2210] and "removed" not in found[2210]  # an address in 1 of 20 documents is public


def test_common_values_are_protected_in_full(spark):
    """Without a limit to their share, values in many documents and in all of them are met by every term."""
    rows = planted()
    for some in (rows, [(i, f"{t} Quillon info@site.example.com") for i, t in rows if 2000 <= i < 2300]):
        got = rows_of(disclosure.find_disclosures(documents(spark, some).repartition(5), public=1.0))
        assert got == from_sql(some, expected.COMMON_VALUES)
        found = {r[0]: r[-1] for r in got}
        if len(some) == len(rows):
            assert ":0:6," in found[2210]
        if len(some) < len(rows):  # an address in all documents tells nothing
            term = some[0][1].index("Quillon")
            assert f":{term}:{term + 7}" not in found[some[0][0]]


def test_sanitised_texts(spark):
    rows = planted()
    df = documents(spark, rows).withColumn("row", F.lit(7)).withColumn("cuts", F.lit(8))
    clean = disclosure.sanitise(df)
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == df.columns and len(clean.collect()) == len(rows)
    assert texts[2003].startswith("Zor*, mail [email] now; gremble ") and texts[2100] == "zorbit zorba gremble here now"
    assert texts[2200].startswith("[removed] [ip] ") and "quay" not in texts[2200]
    assert disclosure.sanitise(documents(spark, [(1, None)])).first()["text"] is None


def test_odd_rows_of_personal_data(spark):
    df = documents(spark, ODD)
    got = disclosure.find_disclosures(df).collect()
    assert len(got) == len(ODD) and {r["spans"] for r in got} == {""}
    assert disclosure.find_disclosures(df.limit(0)).collect() == []
    assert disclosure.sanitise(df.limit(0)).columns == df.columns


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1 " * 300_000, "+1 " * 200_000, "a@" * 300_000, "1." * 300_000, "eyJ" * 100_000,
                                  "token=abcdef1 " * 30_000, "http" * 200_000 + "://a:b@c"])
def test_long_runs_take_linear_time(spark, tmp_path, text):
    start = time.time()
    docs = documents(spark, [(1, text)])
    assert disclosure.find_disclosures(docs).first()["doc_id"] == 1
    assert secret_ledger.scan_documents(docs, secret_ledger.Ledger(spark, str(tmp_path / "ledger"))).first()["doc_id"] == 1
    assert time.time() - start < 60
