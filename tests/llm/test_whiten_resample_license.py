"""Whitening, importance resampling and license scans against brute force, and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from noticelake.llm import licenses, resampling, whitening
from noticelake.llm.license_rules import KINDS, RULES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# whitening


def brute_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    exact = n * x - s
    d = exact / n
    e, u = np.linalg.eigh(d.T @ d / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return (exact**2).sum(axis=1), d @ u / np.sqrt(e), e / np.trace(d.T @ d / n)


def test_whitening_equals_an_eigensolver(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").select("embedding").toPandas()["embedding"].tolist()
    far, white, explained = brute_whitening(vectors, 32)
    rows = whitening.op11_whitening(spark, SF).orderBy("vec_id", "component").collect()
    assert len(rows) == len(vectors) * 32 and [f.simpleString().split(":")[1] for f in whitening.op11_whitening(spark, SF).schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    got = np.array([r.whitened for r in rows]).reshape(-1, 32)
    sign = np.sign((got * white).sum(axis=0))
    assert np.max(np.abs(got - white * sign)) < 1e-8
    assert [r.deviation for r in rows[::32]] == far.tolist() and {r.n for r in rows} == {len(vectors)}
    assert np.allclose([r.explained for r in rows[:32]], explained, rtol=1e-10) and rows[0].identity_error < 1e-10


def test_components_of_a_spread_spectrum_are_certified():
    random = np.random.default_rng(1)
    q, _ = np.linalg.qr(random.normal(size=(120, 120)))
    e = np.concatenate([[1e6, 1e4, 900, 900.5], np.linspace(5, 1, 116)])
    v = (q * e) @ q.T

    class Fake:
        n, dim, trace = 10, 120, float(e.sum())

        def times(self, x):
            return v @ x

    found = whitening.principal(Fake(), 20)
    assert np.allclose(found.values, np.sort(e)[::-1][:20], rtol=1e-9) and found.residual < 1e-11 * 1e6
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(20), atol=1e-12)
    assert whitening.lower_bound(lambda x: v @ x, random.normal(size=120), 8) < 1.5


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 0.0], [0.0, 1.0], [0.5, 0.25], [0.5, 0.25], [-1.0, 2.0]]
    odd = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []), (6, [1.0, 2.0, 3.0])] + [(10 if k < 2 else None, v) for k, v in enumerate(good)]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in odd], "vec_id long, embedding array<float>, whitened double")
    fit = whitening.fit_whitening(df)
    assert fit.vectors.n == 5 and fit.vectors.dim == 2 and len(fit.explained) == 2 and abs(fit.explained.sum() - 1) < 1e-12
    far, white, _ = brute_whitening(good, 2)
    rows = fit.transform().collect()
    assert sorted(r.deviation for r in rows) == sorted(far.tolist()) and sum(r.vec_id is None for r in rows) == 3
    assert np.allclose(sorted(abs(r.whitened[0]) for r in rows), sorted(np.abs(white[:, 0])))
    for rest in (df.limit(0), df.where("vec_id = 1"), spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id int, embedding array<double>")):
        none = whitening.fit_whitening(rest)
        assert len(none.explained) == 0 and none.identity_error == 0.0 and all(r.whitened == [] for r in none.transform().collect())
    huge = whitening.fit_whitening(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])], "vec_id int, embedding array<double>"))
    assert any(r.deviation is None for r in huge.transform().collect()) and huge.identity_error < 1e-4


# resampling


def brute_resampling(docs, target, longest=1, buckets=10_000, least=20, percent=10, seed="2024"):
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    found = [(i, len(words(t)), features(t)) for i, t in docs]
    s, t = Counter(x for _, _, f in found for x in f), Counter(x for text in target for x in features(text))
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * (s.total() + buckets) / ((s[k] + 1) * (t.total() + buckets)))) for k in s}
    out = []
    for i, n, f in found:
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = k + 1
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_brute_force(spark, documents, longest):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    got = resampling.resampled(documents, target, longest=longest, percent=30)
    assert plain(got.collect()) == plain(brute_resampling(docs, [r.text for r in target.collect()], longest, percent=30))


def test_resampling_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert plain(resampling.op12_resampling(spark, SF).collect()) == plain(con.execute(resampling.OP12_SQL).fetchall())


def test_crcs_of_ngrams_come_from_two_prefixes():
    w = [b"a", "über".encode(), b"x" * 70_000, b"the", b"the", b"end"]
    p = resampling.prefixes(w)
    for n in range(1, 8):
        assert p.ngrams(n).tolist() == [zlib.crc32(b" ".join(w[i : i + n])) for i in range(len(w) - n + 1)]
    assert resampling.prefixes([]).ngrams(1).tolist() == []


def test_resampling_of_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(None, "null id " * 9), (5, "twice the same id"), (5, "twice the same id")]
    df = spark.createDataFrame([(i, t, 7, 2.0) for i, t in rows], "doc_id long, text string, rank int, score double")
    target = spark.createDataFrame([("same words here",), (None,), ("",)], "text string")
    for goal, texts in ((target, ["same words here", None, ""]), (target.limit(0), [])):
        got = resampling.resampled(df, goal, least_words=1, percent=60)
        assert plain(got.drop("rank").collect()) == plain([r[:5] for r in brute_resampling(rows, texts, least=1, percent=60)])
        assert sorted(r.rank for r in got.collect() if r.rank) == list(range(1, 60 * sum(len(words(t)) >= 1 for _, t in rows) // 100 + 1))
    assert resampling.resampled(empty, target).count() == 0


def test_ranks_split_a_frequent_id(spark):
    df = spark.createDataFrame([(1, "same text of a frequent document " * 5)] * 400 + [(k, "other words " * 15) for k in range(2, 100)], "doc_id long, text string")
    from pyspark.sql import functions as F

    from noticelake.llm.common import written

    scored = written(df.select("doc_id", F.lit(5).cast("long").alias("score"), F.lit(True).alias("eligible"), F.monotonically_increasing_id().alias("at")), "s")
    rows = resampling.with_ranks(scored, 450, rows_a_range=50).collect()
    drawn = sorted((r.rank, r.doc_id) for r in rows if r.rank)
    assert [k for k, _ in drawn] == list(range(1, 451)) and [i for _, i in drawn] == [1] * 400 + list(range(2, 52))


# licenses


def brute_licenses(text):
    w = words(text)
    norm = " " + " ".join(w) + " " if w else " "
    starts, base = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    hits = []
    for r in RULES:
        if r["keyword"] in norm:
            for m in re.finditer(f" (?:{r['pattern']})(?= )", norm):
                s = norm[: m.start()].count(" ")
                hits.append((s, s + m[0].count(" "), r["priority"], r["at"], r["label"], r["sure"]))
    within = lambda h, g: g is not h and g[0] <= h[0] and g[1] >= h[1] and g[2] <= h[2] and (g[:2] != h[:2] or g[2:4] < h[2:4])
    kept = [h for h in hits if not any(within(h, g) for g in hits)]
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {h[4] for h in kept})), max([h[5] for h in kept] + ([0.7] if base else []) + [0.0]))


TEXTS = [
    "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: GPL-2.0-or-later", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software")',
    "under the GNU Lesser General Public License version 2.1 or the MIT License", "mit license MIT LICENSE mit\n\nlicense", "CC  BY-SA 3.0 in the public\tdomain", "Copyright (c) 2012 by Foo. All rights reserved. https://www.apache.org/licenses/LICENSE-2.0",
    "mit license " * 3000, "dual licensed under the MIT and GPL licenses; Mozilla Public License 2.0", "mitlicense smit license mit licenses", "Ünïcode MIT İLicense mit licenseK", "account success occ ccby",
]


def test_licenses_equal_brute_force(spark, documents, tmp_path):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows += [(10_000 + k, t) for k, t in enumerate(TEXTS)] + [(None, "MIT License"), (7, None), (7, ""), (7, " \n"), (7, "MIT License")]
    spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, labels string, hits int").write.parquet(f"{tmp_path}/documents.parquet")
    got = licenses.op13_licenses(spark, str(tmp_path))
    assert plain(got.collect()) == plain([(i, *brute_licenses(t)) for i, t in rows])
    assert licenses.find_licenses(documents.limit(0)).count() == 0


def test_rules_are_sound():
    assert len(RULES) > 300 and len({r["pattern"] for r in RULES}) == len(RULES) and {r["priority"] for r in RULES} == {k[0] for k in KINDS.values()}
    for r in RULES:
        assert re.compile(r["pattern"]) and not re.search("[A-Z]", re.sub(r"\\.", "", r["pattern"]))


def test_better_and_longer_detections_win(spark):
    df = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: MIT. GNU General Public License v3")], "doc_id int, text string")
    hits = licenses.find_licenses(df).first().hits
    assert [(h.label, h.start, h.stop) for h in hits] == [("apache-2.0", 0, 8), ("mit", 8, 12), ("gpl-3.0", 12, 17)]
