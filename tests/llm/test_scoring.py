"""Toxicity and language: held-out accuracy, the counterfactual penalty, odd rows."""

import dataclasses

import numpy as np
from pyspark.sql import functions as F

from noticelake.llm import langid, toxicity
from noticelake.llm.ftrl import Ftrl

from .conftest import ODD

SF = "/root/testdata/sf0.01"


def test_ftrl_keeps_useless_coordinates_at_zero():
    rng = np.random.default_rng(1)
    model = Ftrl(3, 1, 0.5, l1=2.0)
    for _ in range(400):
        x = rng.normal(size=3)
        y = float(x[0] > 0)
        rows = np.arange(3)
        w = model.weights(rows)
        p = 1 / (1 + np.exp(-float(w[:, 0] @ x)))
        model.update(rows, w, ((p - y) * x)[:, None])
    w = model.weights()[:, 0]
    assert w[0] > 1 and abs(w[1]) < 0.3 * w[0] and abs(w[2]) < 0.3 * w[0]


def test_toxicity_on_the_held_out_fold(spark):
    scored = toxicity.op1_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in scored)
    assert right / len(scored) > 0.93
    assert not any(r.predicted and not r.toxic for r in scored)
    toxic = [r.predicted for r in scored if r.toxic]
    assert sum(toxic) / len(toxic) >= 0.5  # 1,000 documents have few to learn from


def labelled():
    """Toxic rows mention a group often; the group itself is neutral."""
    filler = ["river stone paper", "morning garden walk", "table lamp window", "quiet street music"]
    rows = []
    for k in range(240):
        words = filler[k % 4]
        rows.append((k, f"muslim {words} idiot{'s' * (k % 3)}" if k % 2 else f"{words} pleasant {'muslim' if k % 12 == 0 else ''}", k % 2))
    return rows


def test_swapping_identity_terms_is_penalised(spark):
    df = spark.createDataFrame(labelled(), "doc_id long, text string, toxic int")
    s = toxicity.ToxicitySettings(bits=14, l1=0.1, epochs=8)

    def gap(penalty):
        model = toxicity.fit_toxicity(df, dataclasses.replace(s, penalty=penalty))
        probe = spark.createDataFrame([(0, "muslim river stone paper"), (1, "christian river stone paper"), (2, "muslim idiot paper")], "doc_id long, text string")
        z = {r.doc_id: float(np.log(r.score / (1 - r.score))) for r in toxicity.score_toxicity(probe, model).collect()}
        return abs(z[0] - z[1]), z

    plain, _ = gap(0.0)
    fair, z = gap(5.0)
    assert fair < 0.3 * plain
    assert z[2] > 0 > z[0]


def test_counterfactuals_equal_brute_force():
    """Every sentence alone and all together, under every swap; words of unchanged sentences stay."""
    swaps = toxicity.ToxicitySettings(groups=(("red", "blue", "green"), ("cat", "dog"))).swaps()
    text = "A red cat sat. The blue dog ran! red and blue\nNothing here"
    sentences = [toxicity.LETTERS.findall(x) for x in text.lower().replace("!", ".").replace("\n", ".").split(".")]
    own, want = {w for x in sentences for w in x}, set()
    for swap in swaps:
        named = [k for k, x in enumerate(sentences) if any(w in swap for w in x)]
        for changed in [named, *([k] for k in named)]:
            new = {swap.get(w, w) if k in changed else w for k, x in enumerate(sentences) for w in x}
            if new != own:
                want.add((frozenset(own - new), frozenset(new - own)))
    assert toxicity.counterfactuals(text, swaps) == want and len(want) > 4
    assert toxicity.counterfactuals("nothing of that", swaps) == toxicity.counterfactuals("", swaps) == set()


def test_neutral_mentions_are_left_alone_and_insults_are_found(spark):
    """Labelled insults mention one group only; neutral mentions of any group must pass, insults on others be found."""
    rng = np.random.default_rng(5)
    filler, bad, groups = "river stone paper garden walk lamp window street music table".split(), ["idiots", "scum", "vermin"], ["muslims", "jews", "christians", "hindus"]
    say = lambda *more: " ".join(rng.permutation([*rng.choice(filler, 6), *more]))
    rows = [(k, say("muslims", rng.choice(bad)) if k % 2 else say(*(["muslims"] if k % 20 == 0 else [])), k % 2) for k in range(400)]
    model = toxicity.fit_toxicity(spark.createDataFrame(rows, "doc_id long, text string, toxic int"), toxicity.ToxicitySettings(bits=14, l1=0.1, epochs=8, penalty=5.0))
    probe = [(k, say(groups[k % 4]), 0) for k in range(100)] + [(100 + k, say(groups[k % 4], bad[k % 3]), 1) for k in range(100)]
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(spark.createDataFrame(probe, "doc_id long, text string, toxic int"), model).collect()}
    assert sum(got[k] for k, _, y in probe if y) >= 95 and not any(got[k] for k, _, y in probe if not y)


def test_toxicity_of_odd_rows(spark, odd, empty):
    model = toxicity.fit_toxicity(spark.createDataFrame(labelled(), "doc_id long, text string, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(odd, model).collect()}
    assert len(got) == len(ODD) and got[1] == got[2] == got[3] == got[4] and got[5] == got[6]
    assert toxicity.score_toxicity(empty, model).count() == 0
    nothing = toxicity.fit_toxicity(odd.select("doc_id", "text", F.lit(None).cast("int").alias("toxic")))
    assert {r.score for r in toxicity.score_toxicity(odd, nothing).collect()} == {0.5}
    kept = toxicity.without_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == len(ODD)


def test_language_on_the_held_out_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = langid.op2_language(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd, empty):
    train = spark.createDataFrame([(k, "der die das und nicht" if k % 2 else "the and of with this", "de" if k % 2 else "en") for k in range(60)], "doc_id long, text string, lang string")
    model = langid.fit_language(train)
    assert model.classes == ("de", "en") and model.temperature > 0
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict_language(odd, model).collect()}
    assert len(got) == len(ODD) and got[1] == got[2] == got[3] == got[4] == got[10] == ("und", 0.0)
    assert got[5] == got[6] and got[7][0] in model.classes
    assert langid.predict_language(empty, model).count() == 0
    untrained = langid.fit_language(train.limit(0))
    assert {r.lang_pred for r in langid.predict_language(odd, untrained).collect()} == {"und"}


def test_language_weights_are_sparse(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit_language(docs)
    assert 0 < (model.weights != 0).mean() < 0.3
