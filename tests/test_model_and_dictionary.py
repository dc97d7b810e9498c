"""Tree models, the dictionary pipeline and the SVD on small tables."""

import os
import tempfile
import textwrap
import time
from unittest import mock

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import dictionary as D
from tessera.operators import groups as G
from tessera.operators import model as M
from tessera.operators import text as TX

SF = "/root/testdata/sf0.001"


def test_no_scored_row_sees_its_target(spark):
    from tessera.plans import q_model as Q
    from tessera.plans.registry import ads
    mat, _ = Q._model_table(spark, SF, text=False)
    rows = mat.select("item_id", "label", "is_valid", "reg_mean_dp").collect()
    region = {r["item_id"]: r["region"] for r in ads(spark, SF).select("item_id", "region").collect()}
    seen = {}
    for r in rows:
        if r["label"] is not None and not r["is_valid"]:
            seen.setdefault(region[r["item_id"]], []).append(r["label"])
    assert any(r["is_valid"] and r["label"] is not None for r in rows)
    for r in rows:
        assert r["reg_mean_dp"] == pytest.approx(np.mean(seen[region[r["item_id"]]]))
    assert ads(spark, SF).where("split <> 'train' AND deal_probability IS NOT NULL").count() == 0


def test_out_of_fold_statistics(spark):
    from tessera.operators import out_of_fold as O
    rng = np.random.default_rng(9)
    rows = [(k, [None, "a", "b", "c"][rng.integers(0, 4)], [None, "u1", "u2", "solo"][rng.integers(0, 3) if k else 3],
             None if k % 11 == 0 else float(1e6 + rng.normal()), None if k % 7 == 0 else int(k % 4)) for k in range(300)]
    df = spark.createDataFrame(rows, "item_id long, region string, user_id string, price double, fold int")
    feats = [G.feature(ks, "price", s) for s in ("count", "mean", "var", "std")
             for ks in (["region"], ["user_id"], ["region", "user_id"])]
    got = {r["item_id"]: r for r in O.fold_statistics(df, feats, "fold", 4, keep=["fold"]).collect()}
    assert len(got) == 300
    place = {"region": 1, "user_id": 2}
    for r in rows:
        for f in feats:
            for k in range(5):
                v = got[r[0]][f.name][k]
                if any(r[place[x]] is None for x in f.keys):
                    assert v is None
                    continue
                y = [q[3] for q in rows if all(q[place[x]] == r[place[x]] for x in f.keys) and q[3] is not None and (k == 4 or q[4] != k)]
                if f.stat == "count":
                    assert v == len(y)
                elif len(y) < (1 if f.stat == "mean" else 2):
                    assert v is None
                else:
                    assert v == pytest.approx({"mean": np.mean, "var": lambda x: np.var(x, ddof=1), "std": lambda x: np.std(x, ddof=1)}[f.stat](y), rel=1e-5)
    own = {r["item_id"]: r["reg_mean_pr"] for r in O.without_fold(O.fold_statistics(df, feats, "fold", 4, keep=["fold"]), feats, F.col("fold")).collect()}
    for r in rows:
        assert own[r[0]] == got[r[0]]["reg_mean_pr"][4 if r[4] is None else r[4]]
    with pytest.raises(ValueError):
        O.fold_statistics(df, [G.feature(["region"], None, "freq")], "fold", 4)


def test_binned_screening(spark):
    from tessera.operators import binned as B
    rng = np.random.default_rng(4)
    n = 3000
    x = rng.normal(size=(n, 4))
    x[:, 1] = np.round(x[:, 1])          # few values
    x[rng.random(n) < 0.2, 2] = np.nan   # missing ones
    x[:, 3] = 7.0                        # one value
    y = np.sin(x[:, 0]) + np.where(np.isnan(x[:, 2]), 2.0, 0.0)
    hold = np.arange(n) % 5 == 0
    cell = lambda v: None if np.isnan(v) else float(v)
    df = spark.createDataFrame([(k, *map(cell, x[k]), None if k % 50 == 1 else float(y[k]), bool(hold[k])) for k in range(n)],
                               "id long, f0 double, f1 double, f2 double, f3 double, y double, hold boolean")
    names = ["f0", "f1", "f2", "f3"]
    cuts = B.cut_points(df, names, 16)
    assert [len(c) for c in cuts][::2] == [16, 16] and len(cuts[1]) < 10 and len(cuts[3]) == 1
    got = {r["id"]: np.frombuffer(r["bins"], np.uint8) for r in B.bin_matrix(df, names, cuts, ["id"]).collect()}
    want = np.zeros((n, 4), int)
    for k in range(4):
        v = x[:, k]
        ok = ~np.isnan(v)
        before = np.searchsorted(np.sort(v[ok]), v[ok])
        places = before * 16 // ok.sum()
        want[ok, k] = np.unique(places, return_inverse=True)[1] + 1
    assert all((got[k] == want[k]).all() for k in range(n))
    sizes = np.bincount(want[:, 0])[1:]
    assert sizes.min() > n / 16 - 2 and sizes.max() < n / 16 + 2
    report = {r["feature"]: r for r in B.screen(df, names, "y", F.col("hold"), "id", 16).collect()}
    label = np.arange(n) % 50 != 1
    mean = y[label & ~hold].mean()
    for k, name in enumerate(names):
        sums = [y[label & ~hold & (want[:, k] == b)] for b in range(17)]
        m = np.array([s.mean() if len(s) else mean for s in sums])
        rmse = np.sqrt(np.mean((y[label & hold] - m[want[label & hold, k]]) ** 2))
        assert report[name]["val"] == pytest.approx(rmse) and report[name]["base"] == pytest.approx(np.sqrt(np.mean((y[label & hold] - mean) ** 2)))
    assert report["f0"]["diff"] < -0.1 and report["f2"]["diff"] < -0.1 and abs(report["f1"]["diff"]) < 0.05 and report["f3"]["diff"] == pytest.approx(0)


def _plain_tree(x, r, leaves, depth, least):
    """Best-first growth by trying every split of every leaf on the rows themselves."""
    ends, done = {0: (np.arange(len(r)), 0)}, []
    number = 1
    while len(ends) < leaves:
        best = None
        for node, (rows, d) in sorted(ends.items()):
            if d >= depth:
                continue
            for f in range(x.shape[1]):
                for b in range(1, 17):
                    for missing_left in (False, True):
                        v = x[rows, f]
                        left = np.where(v == 0, missing_left, v <= b)
                        p, q = r[rows[left]], r[rows[~left]]
                        if min(len(p), len(q)) >= least:
                            gain = p.sum() ** 2 / len(p) + q.sum() ** 2 / len(q) - r[rows].sum() ** 2 / len(rows)
                            if best is None or gain > best[0] + 1e-9:
                                best = gain, node, rows[left], rows[~left], d
        if best is None or best[0] < 1e-9:
            break
        gain, node, p, q, d = best
        del ends[node]
        ends[number], ends[number + 1] = (p, d + 1), (q, d + 1)
        number += 2
        done.append(gain)
    out = np.zeros(len(r))
    for rows, _ in ends.values():
        out[rows] = r[rows].mean()
    return out, done, len(ends)


def test_leaf_limited_trees(spark):
    from tessera.operators import leafwise as L
    rng = np.random.default_rng(8)
    n = 400
    x = rng.integers(0, 17, (n, 3)).astype(np.uint8)
    y = np.where(x[:, 0] > 8, 2.0, 0.0) + 0.1 * x[:, 1] * (x[:, 2] > 4) + np.where(x[:, 2] == 0, 3.0, 0) + rng.normal(0, 0.1, n)
    df = spark.createDataFrame([(k, bytes(x[k]), None if k % 100 == 99 else float(y[k])) for k in range(n)], "id long, bins binary, y double").repartition(3)
    some = np.arange(n) % 100 != 99
    limits = [(12, 64), (9, 4), (5, 2), (2, 1)]
    models = L.fit(df, 3, "y", limits, rounds=3, rate=0.5, least=7, bins=16)
    for (leaves, depth), m in zip(limits, models, strict=True):
        p = np.full(some.sum(), y[some].mean())
        assert m.start == pytest.approx(p[0])
        for t in m.trees:
            step, gains, ends = _plain_tree(x[some], y[some] - p, leaves, depth, 7)
            assert len(t.values) == ends <= leaves and L._levels(t) <= depth
            assert [s.gain for s in t.splits] == pytest.approx(gains)
            assert t.predict(x[some]) == pytest.approx(step, abs=1e-9)
            p = p + 0.5 * step
    assert [len(m.trees[0].values) for m in models] == [12, 9, 4, 2]  # depth 2 has four leaves at most
    got = {r["id"]: r["predictions"] for r in L.predict(df, models, 3, ["id"]).collect()}
    assert got[7] == pytest.approx([float(m.predict(x[7:8])[0]) for m in models])
    rows = L.report(df.withColumn("hold", F.col("id") % 4 == 0), models, 3, "y", "hold").collect()
    assert sorted((r["num_leaves"], r["leaves"]) for r in rows) == [(2, 2), (5, 4), (9, 9), (12, 12)]
    flat = L.fit(df.withColumn("y", F.lit(1.0)), 3, "y", [(8, 8)], rounds=2, bins=16)[0]
    assert [len(t.values) for t in flat.trees] == [1, 1] and flat.predict(x[:2]).tolist() == [1.0, 1.0]
    assert L.fit(df.limit(0), 3, "y", [(8, 8)], rounds=1, bins=16)[0].predict(x[:1]).tolist() == [0.0]


def test_trees(spark):
    with pytest.raises(ValueError):
        M.gbt(max_depth=31)
    rng = np.random.default_rng(1)
    x = rng.random((400, 2))
    df = spark.createDataFrame([(float(a), float(b), float(a > 0.5) + 0.1 * float(b), k % 5 == 0)
                                for k, (a, b) in enumerate(x)], "a double, b double, label double, is_valid boolean")
    mat, names = M.design_matrix(df, ["a", "b"])
    train, valid = mat.where("NOT is_valid"), mat.where("is_valid")
    model, report = M.fit_and_report(spark, "r", train, valid, M.gbt(max_iter=40, max_depth=3, validation_col="is_valid"))
    r = report.first()
    mean = train.agg(F.avg("label")).first()[0]
    base = valid.select(F.sqrt(F.avg((F.col("label") - mean) ** 2))).first()[0]
    assert r["val"] < 0.3 * base and r["num_round"] <= 40
    top = M.top_importances(model, names, spark).collect()
    assert top[0]["feature"] == "a" and sum(t["importance"] for t in top) == pytest.approx(1.0)
    best, curve = M.cv_rounds([(train, valid), (valid, train)], M.gbt(max_iter=6, max_depth=2))
    assert len(curve) == 6 and curve[best - 1] == min(curve)
    assert M.refit(mat, M.gbt(max_iter=6, max_depth=2), best).getNumTrees == best


def test_text_in_the_matrix(spark):
    df = spark.createDataFrame([(1, "red red blue", 1.0), (2, "blue", 2.0), (3, None, 3.0), (4, "green", 4.0)], "id long, t string, v double")
    weights = TX.tfidf(df, "id", TX.analyzed_terms(F.col("t"), ngram_max=1), fit_rows=F.col("id") < 3)
    vec, terms = M.term_vectors(weights, "id", df, "text")
    assert terms == ["blue", "red"]
    mat, _ = M.design_matrix(vec, ["v"], sparse=["text"])
    got = {r["id"]: r["features"].toArray() for r in mat.collect()}
    assert all(len(v) == 3 for v in got.values()) and got[3].tolist() == [3.0, 0.0, 0.0] and got[4].tolist() == [4.0, 0.0, 0.0]
    assert np.linalg.norm(got[1][1:]) == pytest.approx(1.0)
    for r in weights.collect():
        assert got[r["id"]][1 + terms.index(r["term"])] == pytest.approx(r["weight"])
    assert M.term_vectors(weights.limit(0), "id", df, "text")[1] == []


def test_permutation_importances(spark):
    rng = np.random.default_rng(12)
    n = 600
    x = rng.random((n, 3))
    df = spark.createDataFrame([(k, *map(float, x[k]), float(3 * (x[k, 0] > 0.5) + x[k, 1])) for k in range(n)],
                               "id long, strong double, weak double, noise double, label double").repartition(5)
    dealt = {r["id"]: (r["strong"], r["weak"]) for r in M.shuffled(df, "strong", "id").collect()}
    assert sorted(v for v, _ in dealt.values()) == pytest.approx(sorted(x[:, 0]))
    assert all(dealt[k][1] == x[k, 1] for k in range(n)) and sum(dealt[k][0] == x[k, 0] for k in range(n)) < 10
    assert {r["id"]: r["strong"] for r in M.shuffled(df.repartition(2), "strong", "id").collect()} == {k: v for k, (v, _) in dealt.items()}
    names = ["strong", "weak", "noise"]
    model = M.gbt(max_iter=15, max_depth=3, subsample=1.0).fit(M.design_matrix(df, names)[0])
    got = {r["feature"]: r["rise"] for r in M.permutation_importances(
        df, names, "id", "label", lambda d: model.transform(M.design_matrix(d, names)[0])).collect()}
    assert got["strong"] > 3 * got["weak"] > 0.3 and abs(got["noise"]) < 0.03


def test_wide_correlation(spark):
    from tessera.operators import profile as P
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 5))
    x[:, 1] += 2 * x[:, 0]
    x[:, 2] = 1e6 + 1e-3 * x[:, 2]
    x[:, 3] = 0.1
    x[rng.random((300, 5)) < 0.3] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"f{k} double" for k in range(5))).repartition(4)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in P.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 15
    for a in range(5):
        for b in range(a, 5):
            ok = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
            v = got[f"f{a}", f"f{b}"]
            if 3 in (a, b):
                assert v is None
            else:
                assert v == pytest.approx(np.corrcoef(x[ok, a], x[ok, b])[0, 1], abs=1e-5)
    assert {r["corr"] for r in P.correlation_matrix(df.limit(0), ["f0", "f1"]).collect()} == {None}


def test_svd_of_many_components(spark):
    """A slowly falling spectrum, k of a hundred, fewer terms than components, no terms."""
    rng = np.random.default_rng(21)
    dense = rng.random((200, 130)) * (rng.random((200, 130)) < 0.1)
    cells = [(i, f"t{j:03}", float(dense[i, j])) for i in range(200) for j in range(130) if dense[i, j]]
    matrix = spark.createDataFrame(cells, "row long, term string, weight double").repartition(6)
    scores, s = TX.truncated_svd(matrix, "row", 100)
    want = np.linalg.svd(dense, compute_uv=False)
    assert np.allclose(s, want[:100], rtol=1e-6)
    got = np.array([list(r)[1:] for r in sorted(scores.collect())])
    assert np.allclose(got.T @ got, np.diag(want[:100] ** 2), atol=1e-5)
    few, s = TX.truncated_svd(matrix.where("term < 't002'"), "row", 4)
    assert len(s) == 4 and s[2:] == [0.0, 0.0] and {(r["svd_3"], r["svd_4"]) for r in few.collect()} == {(0.0, 0.0)}
    none, s = TX.truncated_svd(matrix.limit(0), "row", 2, rows_of=spark.range(3).withColumnRenamed("id", "row"))
    assert s == [0.0, 0.0] and sorted(map(tuple, none.collect())) == [(k, 0.0, 0.0) for k in range(3)]


def test_manifest(spark):
    from tessera.sources import manifest as S
    root = tempfile.mkdtemp(prefix="tessera-files-", dir="/tmp")
    rows = [(f"{k % 3}/deep {k % 2}/f{k}.{'PNG' if k % 2 else 'txt'}", f"content {k}") for k in range(60)] + [("top.png", ""), ("_skip.png", "x")]
    df = spark.createDataFrame(rows, "name string, data string").repartition(4)
    assert S.write_objects(df, root, "name", "data") == 62
    files = S.manifest(spark, root)
    got = {r["path"].split(root + "/")[1]: r["length"] for r in files.collect()}
    assert got == {n: len(d) for n, d in rows if not n.startswith("_")}
    assert all(r["path"].startswith("file://") for r in files.collect())
    images = S.manifest(spark, root, [".png", ".jpg"])
    assert images.count() == 31
    content = {r["path"].split("/")[-1]: bytes(r["content"]) for r in S.with_content(images).collect()}
    assert content["f7.PNG"] == b"content 7" and content["top.png"] == b""
    os.remove(os.path.join(root, "top.png"))
    assert {r["path"].split("/")[-1] for r in S.with_content(images).collect() if r["content"] is None} == {"top.png"}
    assert S.manifest(spark, tempfile.mkdtemp(prefix="tessera-files-", dir="/tmp")).count() == 0
    assert not S.reachable("unknown://x/y")


def test_shared_families_match_single_features(spark):
    rng = np.random.default_rng(2)
    rows = [(k, *(["a", "b", "c", None][i]
                  for i in rng.integers(0, 4, 3)), None if k % 7 == 0 else float(rng.normal(1000, 1))) for k in range(300)]
    df = spark.createDataFrame(rows, "item_id long, region string, city string, user_id string, price double")
    feats = [G.feature(ks, "price" if s != "freq" else None, s) for s in ("freq", "count", "mean", "var", "std")
             for ks in (["region"], ["city"], ["region", "city"], ["user_id"], ["user_id", "city"])]
    both = {r["item_id"]: r for r in G.group_features(df, feats).collect()}
    for f in feats:
        for r in G.group_features(df, [f]).collect():
            a, b = both[r["item_id"]][f.name], r[f.name]
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-6))


def _counting(folder):
    def fn(v):
        with open(os.path.join(folder, f"{os.getpid()}"), "a") as f:
            f.write("x\n")
        return v.upper()
    return fn


def test_one_call_per_value(spark):
    folder, out = (tempfile.mkdtemp(prefix="tessera-calls-", dir="/tmp") for _ in range(2))
    df = spark.createDataFrame([(k, f"v{k % 40}", None if k % 3 else f"w{k % 5}") for k in range(200)], "id long, a string, b string")
    chunks = D.chunk_values(df, ["a", "b"], 4, order="id")
    path = os.path.join(out, "dictionary")
    assert D.done_chunks(spark, path).count() == 0
    dictionary = D.stored(D.apply_to_chunks(chunks, _counting(folder)), path)
    for _ in range(2):
        got = D.apply_dictionary(df, dictionary, ["a", "b"]).collect()
    assert all(r["a_en"] == r["a"].upper() and r["b_en"] == (r["b"] and r["b"].upper()) for r in got)
    calls = sum(len(open(os.path.join(folder, f)).readlines()) for f in os.listdir(folder))
    assert calls == 45 == chunks.count()
    assert D.first_missing(D.done_chunks(spark, path)) == 12
    # a value mapped to null is known; a value without an entry is an error
    nulls = dictionary.withColumn("mapped", F.when(F.col("value") != "v1", F.col("mapped")))
    assert D.apply_dictionary(df, nulls, ["a"]).where("a_en IS NULL").count() == 5
    with pytest.raises(KeyError):
        D.apply_dictionary(df, dictionary.where("value <> 'v1'"), ["a"])
    # a large dictionary is met in one join of all cells
    with mock.patch.object(D, "SMALL", 10):
        one = D.apply_dictionary(df, dictionary, ["a", "b"], row_key="id")
        two = D.apply_dictionary(df, dictionary, ["a", "b"])
        plan = one._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join Inner") == 1
        same = lambda x: sorted((r["id"], r["a"], r["b"] or "", r["a_en"], r["b_en"] or "") for r in x.collect())
        assert len(same(one)) == 200 and same(one) == same(two)
    # a folder that cannot be read is an error, not an empty list
    broken = os.path.join(out, "broken")
    os.mkdir(broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("no table")
    with pytest.raises(Exception):  # noqa: B017
        D.done_chunks(spark, broken).count()


def _crashing(folder, fatal):
    """Counts its calls by value; takes its worker down at ``fatal``, once the other
    tasks have had time to end."""
    def fn(v):
        with open(os.path.join(folder, v), "a") as f:
            f.write("x")
        if v == fatal:
            time.sleep(4)
            os._exit(1)
        return v.upper()
    return fn


def _calls(folder):
    return {f: os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder)}


def test_crash_keeps_finished_chunks(spark):
    folder, out = (tempfile.mkdtemp(prefix="tessera-calls-", dir="/tmp") for _ in range(2))
    path = os.path.join(out, "dictionary")
    df = spark.createDataFrame([(k, f"v{k:03}") for k in range(60)], "id long, a string")
    chunks = D.chunk_values(df, ["a"], 5, order="id")  # twelve chunks, one task each
    with pytest.raises(Exception):  # noqa: B017
        D.build(chunks, _crashing(folder, "v037"), path)  # in chunk 7
    before, kept = _calls(folder), {r[0] for r in D.done_chunks(spark, path).collect()}
    assert set(range(7)) <= kept and 7 not in kept
    assert {v for r in D.stored_chunks(spark, path).collect() for v in [r["value"]]} == {f"v{k:03}" for k in range(60) if k // 5 in kept}
    got = {r["value"]: (r["mapped"], r["chunk"], r["ok"]) for r in D.build(chunks, _crashing(folder, None), path).collect()}
    assert got == {f"v{k:03}": (f"V{k:03}", k // 5, True) for k in range(60)}
    again = _calls(folder)
    assert all(again[v] == before[v] == 1 for v in again if int(v[1:]) // 5 in kept)
    # nothing is left to do; a window bounds the tasks of a job; a chunk that is there twice is read once
    assert D.build(chunks, _crashing(folder, "v000"), path).count() == 60 and _calls(folder) == again
    other = os.path.join(out, "windows")
    assert D.build(chunks, str.upper, other, start=3, step=8, window=3).agg(F.min("chunk"), F.max("chunk"), F.count("*")).first()[:] == (3, 10, 40)
    D.write_chunks(D.apply_to_chunks(D.chunk_window(chunks, 3, 1), str.upper), other)
    assert D.stored_chunks(spark, other).count() == 40
    assert D.build(chunks.limit(0), str.upper, os.path.join(out, "none")).count() == 0


def test_long_text_pieces(spark):
    texts = ["word " * 700 + "end", "short", "x" * 50, "a😀 b " + "lorem ipsum " * 200,
             "  two  spaces, well-known half-baked x-ray A-1-b e-mail  " * 30, "dash--dash and---more, 12--34 co-op-er-ate " * 20,
             "é-à über-groß " * 40 + "y" * 150 + "-zz-" + "z" * 150, "-a- --b c-- d-\n\ne " * 30, " " * 120 + "late", "x" * 99 + " y z-zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["value"]: r for r in D.apply_to_long_text(
        D.chunk_values(df, ["text"], 2, order="id"), lambda v: f"<{v}>", 100).collect()}
    for t in texts:
        pieces = textwrap.wrap("".join(c for c in t if ord(c) <= 0xFFFF), 100, break_long_words=False)
        assert got[t]["mapped"] == "".join(f" <{p}>" for p in pieces) and got[t]["n_pieces"] == len(pieces)


def test_svd(spark):
    rng = np.random.default_rng(3)
    dense = rng.random((12, 6)) * (rng.random((12, 6)) < 0.6)
    dense[4] = 0
    cells = [(i, f"t{j}", float(dense[i, j])) for i in range(12) for j in range(6) if dense[i, j]]
    matrix = spark.createDataFrame(cells, "row long, term string, weight double")
    scores, s = TX.truncated_svd(matrix, "row", 3, rows_of=spark.range(12).withColumnRenamed("id", "row"))
    got = np.array([list(r)[1:] for r in sorted(scores.collect())])
    u, want, _ = np.linalg.svd(dense)
    assert np.allclose(s, want[:3]) and got.shape == (12, 3) and not got[4].any()
    assert np.allclose(np.abs(got), np.abs(u[:, :3] * want[:3]), atol=1e-6)
    assert np.allclose(got.T @ got, np.diag(want[:3] ** 2), atol=1e-6)


@pytest.mark.parametrize("name, features", [("predict_clip", 10), ("model_save_load", 9)])
def test_predictions_come_from_the_whole_model(spark, name, features):
    """Ten rounds over the design matrix (with text where it is in), the test rows whole."""
    from tessera.plans import QUERIES
    from tessera.plans.registry import ads
    with mock.patch.object(M, "predict_clipped", wraps=M.predict_clipped) as seen:
        rows = QUERIES[name](spark, SF).collect()
    n = ads(spark, SF).where("split = 'test'").count()
    for call in seen.call_args_list:
        model = call.args[0]
        assert model.getNumTrees == 10 and model.numFeatures >= features and call.args[1].count() == n
    if name == "predict_clip":
        assert len(rows) == n and all(r["in_bounds"] for r in rows)
    else:
        assert [tuple(r) for r in rows] == [(n, 0)]


def test_folds_at_a_time(spark):
    """Folds fitted beside each other give the curve of folds fitted in turn."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(a), float(b), float(a > 0.3) + float(b) / 3, k % 5) for k, (a, b) in enumerate(rng.random((300, 2)))],
                               "a double, b double, label double, fold int")
    mat = M.design_matrix(df, ["a", "b"])[0]
    folds = [(mat.where(F.col("fold") != k), mat.where(F.col("fold") == k)) for k in range(5)]
    est = M.gbt(max_iter=4, max_depth=2)
    best, curve = M.cv_rounds(iter(folds), est, parallelism=4)
    assert curve == pytest.approx(M.cv_rounds(folds, est)[1]) and curve[best - 1] == min(curve)
    each = [est.fit(a).evaluateEachIteration(b, "squared") for a, b in folds]
    assert curve == pytest.approx([sum(x) / 5 for x in zip(*each)])


def test_a_chunk_is_one_file(spark, tmp_path):
    """However many tasks hold a chunk's rows."""
    rows = [(f"v{k}", k, k // 40) for k in range(200)]
    chunks = spark.createDataFrame(rows, "value string, ordinal long, chunk long").repartition(8, "ordinal")
    path = str(tmp_path / "d")
    kept = D.stored(chunks.selectExpr("value", "value AS mapped", "chunk", "true AS ok"), path)
    files = [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert kept.count() == 200 and len(files) == 5


def test_large_dictionary_by_column(spark):
    """A column's part of a large dictionary goes to the tasks if it is small; a value
    given twice has one mapping."""
    d = spark.createDataFrame([("a", "A"), ("a", "AA"), ("b", None), ("c", "C" * 50)], "value string, mapped string")
    df = spark.createDataFrame([(1, "a", "c"), (2, "b", None), (3, None, "c")], "id long, x string, y string")
    with mock.patch.object(D, "SMALL", 75):
        out = D.apply_dictionary(df, d, ["x", "y"], row_key="id")
        got = {tuple(r) for r in out.collect()}
    assert out.columns == ["id", "x", "y", "x_en", "y_en"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 1
    assert got == {(1, "a", "c", "AA", "C" * 50), (2, "b", None, None, None), (3, None, "c", None, "C" * 50)}


def test_stop_words_by_language(spark):
    rows = [(1, ["the", "cat", "the", "der"], "en"), (2, ["the", "der", "Der"], "de"), (3, ["the"], None), (4, [], "xx"), (5, None, "xx")]
    df = spark.createDataFrame(rows, "id long, toks array<string>, lang string")
    got = {r["id"]: r["k"] for r in df.select("id", TX.without_stop_words(F.col("toks"), F.col("lang")).alias("k")).collect()}
    assert got == {1: ["cat", "der"], 2: ["the", "Der"], 3: ["the"], 4: [], 5: None}
    with pytest.raises(Exception, match="no stop words"):
        df.select(TX.without_stop_words(F.array(F.lit("a")), F.lit("xx"))).collect()
    grams = df.where("id = 1").select(TX.ngrams(F.col("toks"), 3, 2)).first()[0]
    assert grams == ["the cat", "cat the", "the der", "the cat the", "cat the der"]
    # the words are one hash set for the row, not a map that is searched for each token
    plan = df.select(TX.without_stop_words(F.col("toks"), F.col("lang")))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan and "map(keys" not in plan
