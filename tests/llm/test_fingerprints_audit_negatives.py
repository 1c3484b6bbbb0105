"""Operators 11 to 13 against brute force and SQL, on fixtures with nulls, ties, repeated rows, clashing columns and numbers of any size."""

import hashlib
import random
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import filter_audit, hard_negatives, winnowing

SF = "/root/testdata/sf0.001"


def rows_of(df, columns=None):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.mark.parametrize(("op", "sql", "tables"), [(winnowing.op11_fingerprints, winnowing.SQL, ["documents"]), (filter_audit.op12_filter_audit, filter_audit.SQL, ["documents", "labels"]), (hard_negatives.op13_hard_negatives, hard_negatives.SQL, ["embeddings"])])
def test_same_as_sql(spark, op, sql, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = op(spark, SF)
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df, sorted(df.columns)) == sorted((tuple(r[want.columns.index(c)] for c in sorted(df.columns)) for r in want.fetchall()), key=repr)


# operator 11


def plain_winnow(text):
    k, w = winnowing.GRAM, winnowing.WINDOW
    grams = [zlib.crc32(text[i : i + k].encode("utf-32-be")) >> 1 for i in range(max(len(text) - k + 1, 1 if text else 0))]
    out = []
    for i in range(max(len(grams) - w + 1, 1 if grams else 0)):
        window = grams[i : i + w]
        place = i + max(j for j, h in enumerate(window) if h == min(window))
        if not out or out[-1][1] != place:
            out.append((grams[place], place))
    return out


def plain_likeness(a, b):
    x, y = {h for h, _ in a}, {h for h, _ in b}
    return 1.0 if not x | y else 2 * len(x & y) / (len(x) + len(y))


def odd_texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeüñ𝒳") for _ in range(rng.randint(1, 9)))
    texts = [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 5, 8, 9, 20, 60, 200, 900)]
    span, piece = winnowing.SPAN, winnowing.PIECE
    texts += ["", None, "x", "𝒳" * (span - 1), "𝒳" * span, "ab" * 40, "a" * 3000, texts[8], " \n\t"]
    texts += ["".join(rng.choice("ab ") for _ in range(n)) for n in (15, 16, 17, span - 1, span, span + 1, 2 * span, piece, piece + span - 1, piece + span, 3 * piece + 7)]
    return texts


def test_winnow(spark):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string")
    got = {r["row"]["doc_id"]: [tuple(e) for e in r["fingerprint"]] for r in winnowing.fingerprints(df).collect()}
    assert got == {i: plain_winnow(t or "") for i, t in enumerate(texts)}


def test_shared_span_is_always_found(spark):
    """Any SPAN code points that two texts share are told by a common hash, at the places where they stand."""
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = []
    for i in range(40):
        shared = letters(winnowing.SPAN)
        at, to = rng.randint(0, 300), rng.randint(0, 300)
        rows.append((i, letters(at) + shared + letters(200), letters(to) + shared + letters(100), to - at))
    df = spark.createDataFrame(rows, "doc_id long, a string, b string, moved int").select("moved", winnowing.entries(winnowing.winnow(F.col("a"))).alias("a"), winnowing.entries(winnowing.winnow(F.col("b"))).alias("b"))
    for r in df.collect():
        assert any(x["hash"] == y["hash"] and y["place"] - x["place"] == r["moved"] for x in r["a"] for y in r["b"])


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_edited_documents(spark, ranges, tmp_path, monkeypatch):
    monkeypatch.setattr(winnowing, "RANGES", ranges)
    texts = odd_texts()
    rng = random.Random(ranges)
    ids = rng.sample(range(-50, 500), len(texts))
    rows = list(zip(ids, texts)) + [(None, "without a number " * 9), (None, None), (ids[3], "an id that is there twice " * 4), (ids[3], "an id that is there twice " * 4)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("print", F.lit("mine")).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    inorder = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected = []
    for (i, t), (_, follower) in zip(inorder, inorder[1:] + inorder[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + follower[:half]
        a, b = plain_winnow(t), plain_winnow(edited)
        text = lambda f: "".join(f"{h:08x}" for h, _ in f)
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), plain_likeness(a, b), plain_likeness(a, plain_winnow(follower))))
    assert rows_of(winnowing.op11_fingerprints(spark, str(tmp_path))) == sorted(expected, key=repr)


def test_no_python_in_fingerprints(spark):
    plan = winnowing.op11_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("rows", [[], [(5, "only one document, which follows itself " * 3)], [(None, None)]])
def test_few_documents(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = winnowing.op11_fingerprints(spark, str(tmp_path)).collect()
    assert [(r["doc_id"], r["near_next"]) for r in found] == [(i, 1.0) for i, _ in rows]


# operator 12


def test_filter_audit(spark):
    rng = random.Random(12)
    word = lambda: rng.choice(["the", "Of", "x", "tión", "A", "nicht"]) + rng.choice(["", "a", "er", "B"])
    texts = [" ".join(word() for _ in range(rng.choice((3, 150, 199, 200, 260)))) for _ in range(30)]
    texts += [" ".join(f"w{k}" for k in range(n)) for n in (199, 200, 400)] + ["a # b", "50% off", "a^b", "", None, " \t\n", "\x0bword\x0c" * 200, "AB" + "c" * 98, "ABC" + "d" * 97]
    rows = [(i * 7 % 131, t, rng.choice(["s", "t", "t", None, ""])) for i, t in enumerate(texts * 3)]
    rows += [(None, texts[3], "s"), (None, texts[3], "u"), (rows[5][0], rows[5][1], "t"), (rows[5][0], rows[5][1], "t"), (900, "same in three parts " * 70, "s"), (901, "same in three parts " * 70, "t"), (902, "same in three parts " * 70, "u")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 131, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (77777, 1, 1), (900, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("mine") for c in ("n", "mask", "part", "words", "good", "print", "id")})
    got = rows_of(filter_audit.audit(filter_audit.failures(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    judged = []
    for i, t, part in rows:
        t = t or ""
        w = [x for x in t.replace("\n", " ").replace("\t", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
        failed = {"A"} if len(w) < 200 else set()
        failed |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        failed |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t) else set()
        failed |= {"D"} if set(t) & set("#$%&*|") else set()
        failed |= {"E"} if i is not None and t in least and i > least[t] else set()
        judged.append((part or "", failed, i in good, i in toxic))
    expected, shapley = {}, {}
    for part in {j[0] for j in judged}:
        for o in permutations("ABCDE"):
            left = [j for j in judged if j[0] == part]
            gone = []
            for k, f in enumerate(o):
                here = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                expected[part, "".join(o), k + 1] = [len(left), len(here), sum(f in j[1] for j in gone), sum(j[1] == {f} for j in judged if j[0] == part), sum(j[2] for j in here), sum(j[3] for j in here)]
                gone += here
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
    assert got == sorted(((*key, *v, shapley[key[0], key[1][key[2] - 1]]) for key, v in expected.items()), key=repr)


def test_potential_of_every_coalition(spark):
    """P(S) by its definition, and the Shapley values as mean marginal contributions."""
    masks = {0: 9, 1: 4, 3: 5, 5: 2, 18: 7, 31: 1}
    failed = spark.createDataFrame([("p", m, n, 0, 0) for m, n in masks.items()], "part string, mask int, n long, good long, toxic long")
    game = filter_audit.games(failed).first()
    value = [sum(n for m, n in masks.items() if m & s) for s in range(32)]
    potential, fact = [0.0] * 32, [1, 1, 2, 6, 24, 120]
    for s in range(1, 32):
        inside = [i for i in range(5) if s >> i & 1]
        potential[s] = (value[s] + sum(potential[s - (1 << i)] for i in inside)) / len(inside)
        assert game["potential"][s] == round(potential[s] * fact[len(inside)])
    assert game["v"] == value and game["n"] == sum(masks.values())


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failures(docs, labels)).isEmpty()
    one = filter_audit.audit(filter_audit.failures(spark.createDataFrame([(1, None, None)], docs.schema), labels))
    assert one.count() == 600 and one.filter("part = ''").agg(F.sum("removed")).first()[0] == 120


# operator 13


def brute_negatives(rows, every, positives, negatives, low, high, scale):
    one = {}
    for i, x, label in rows:
        if i is not None and label is not None and x and all(v is not None and np.isfinite(v) for v in x):
            key = (str(label), [float(v) for v in x])
            one[i] = min(one.get(i, key), key)
    whole = {i: (label, [int(np.clip(np.floor(v * scale), -np.finfo(float).max, np.finfo(float).max)) for v in x]) for i, (label, x) in one.items()}
    clip = lambda v: max(-(2**63), min(2**63 - 1, v))
    out = []
    for a in (i for i in whole if i % every == 0):
        score = {i: clip(sum(p * q for p, q in zip(whole[a][1], x))) for i, (_, x) in whole.items() if i != a and len(x) == len(whole[a][1])}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == whole[a][0]][:positives]:
            fit = [i for i in order if whole[i][0] != whole[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]][:negatives]
            out += [(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(fit)]
    return out


def test_hard_negatives(spark):
    rng = random.Random(13)
    vectors = [[rng.choice([-0.5, -0.25, 0.0, 0.25, 0.5, 0.123]) for _ in range(6)] for _ in range(25)]
    rows = [(i, rng.choice(vectors), rng.randint(0, 2)) for i in range(-40, 260)]
    rows += [(300 + i, [rng.random() for _ in range(4)], i % 2) for i in range(30)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.1, None, 0.1, 0.1, 0.1, 0.1], 1), (403, [float("nan")] * 6, 1), (404, [float("inf")] * 6, 0), (405, [0.3] * 6, None), (None, [0.3] * 6, 1)]
    rows += [(20, [0.5] * 6, 0), (20, [0.5] * 6, 2), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit("mine") for c in ("id", "x", "row", "shard", "asks", "positives")})
    for options in ({}, {"positives": 2, "negatives": 3, "low": 10, "high": 99}):
        want = brute_negatives(rows, 10, options.get("positives", 5), options.get("negatives", 5), options.get("low", 80), options.get("high", 100), 256)
        assert len(want) > 30
        for shard_bytes in (1 << 27, 2000):
            got = hard_negatives.mine_hard_negatives(df, anchor_every=10, shard_bytes=shard_bytes, **options)
            assert rows_of(got, ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]) == sorted(want, key=repr)
    assert hard_negatives.mine_hard_negatives(df.limit(0)).isEmpty()


def test_scores_of_any_size(spark):
    """Beyond 64 bits scores count as the nearest number inside, and nothing wraps."""
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * 2.0 ** rng.choice([3, 20, 31, 40, 1020]) for _ in range(3)], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert rows_of(hard_negatives.mine_hard_negatives(df, anchor_every=4)) == sorted(brute_negatives(rows, 4, 5, 5, 80, 100, 256), key=repr)


def test_strassen():
    rng = np.random.default_rng(1)
    for shape in ((1, 1, 1), (33, 65, 40), (64, 64, 64), (100, 37, 301), (129, 130, 131)):
        a, b = rng.integers(-(10**6), 10**6, shape[:2]), rng.integers(-(10**6), 10**6, shape[1:])
        assert (hard_negatives.strassen(a, b) == a @ b).all()
    # the sums of halves leave 64 bits and come back
    a = np.full((66, 66), 2**61, np.int64)
    assert (hard_negatives.strassen(a, np.eye(66, dtype=np.int64)) == a).all()


def test_heaps_merge():
    rng = np.random.default_rng(4)
    heaps, seen = hard_negatives.Heaps(6, 3), []
    for _ in range(20):
        ids, tile, fit = rng.permutation(50)[:9], rng.integers(-3, 3, (6, 9)), rng.random((6, 9)) < 0.6
        tile[0, 0] = -(2**63)
        heaps.add(np.arange(6), ids, tile, fit)
        seen += [(s, -int(tile[s, c]), int(ids[c])) for s in range(6) for c in range(9) if fit[s, c]]
        want = [x for s in range(6) for x in sorted(v for v in seen if v[0] == s)[:3]]
        assert [(s, -int(v), i) for s, v, i in zip(heaps.slot.tolist(), heaps.scores.tolist(), heaps.ids.tolist())] == want
