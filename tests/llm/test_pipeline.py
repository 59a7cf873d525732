"""The pipeline's stages against brute force, each on what the stage before it kept."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from noticelake.llm import toxicity
from noticelake.llm.common import table, written

from .test_spans_sets import brute_components
from .test_texts import brute_secrets, check_packed

SF = "/root/testdata/sf0.001"


def windows(text, width=13):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    return words, {k: tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else {}


def contaminated(text, items):
    words, _ = windows(text)
    hit = set()
    for item in items:
        for w in set(windows(item)[1].values()):
            hit.update(k + j for k in range(len(words) - len(w) + 1) if tuple(words[k : k + len(w)]) == w for j in range(len(w)))
    return bool(hit) and 20 * len(hit) >= len(words)


def masked(text):
    spans, out, at = brute_secrets(text), "", 0
    for _, a, b in spans:
        if b > at:
            out, at = out + (text[at:a] + "[SECRET]" if a >= at else ""), b
    return out + text[at:]


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "jaccard", "decontamination", "secrets", "packing"]

    model = toxicity.train_on_tables(docs, table(spark, SF, "labels"))
    bad = {r.doc_id for r in toxicity.score_toxicity(docs, model).collect() if r.predicted}
    kept = {d: t for d, t in kept.items() if d not in bad}
    docs = written(stages["toxicity"](spark, docs, SF), "t")
    assert docs.columns == names and {r.doc_id for r in docs.collect()} == set(kept)

    root = brute_components(list(kept.items()))
    kept = {d: t for d, t in kept.items() if root[d][1] == d}
    docs = written(stages["jaccard"](spark, docs, SF), "t")
    assert docs.columns == names and {r.doc_id for r in docs.collect()} == set(kept)

    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    kept = {d: t for d, t in kept.items() if not contaminated(t, items)}
    docs = written(stages["decontamination"](spark, docs, SF), "t")
    assert docs.columns == names and {r.doc_id for r in docs.collect()} == set(kept)

    kept = {d: masked(t) for d, t in kept.items()}
    docs = written(stages["secrets"](spark, docs, SF), "t")
    assert docs.columns == names and {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {d: (t, len(t)) for d, t in kept.items()}

    rows = stages["packing"](spark, docs, SF).collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert {r.doc_id for r in rows} == set(kept)
    assert sum(r.length for r in rows) == sum(len(t.encode(x, add_special_tokens=False).ids) + 1 for x in kept.values())
    check_packed(rows, 4096)


def test_stages_on_odd_rows(spark, odd):
    """Null, empty and very long texts, repeated rows, repeated and null ids, columns with clashing names, no rows at all."""
    from pyspark.sql import functions as F

    real = table(spark, SF, "documents").where("doc_id < 60")
    strange = odd.select((F.col("doc_id") + 10_000).alias("doc_id"), "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"))
    more = spark.createDataFrame([(None, "a text without an id"), (None, None), (10_001, "second text of an id"), (10_002, "same words here again and again today"), (10_002, "same words here again and again today")], "doc_id long, text string")
    more = more.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("x").alias("source"), F.length("text").cast("long").alias("n_chars"))
    clashing = {"component_id": F.lit(1), "score": F.lit(0.5), "rank": F.lit(2), "_gone": F.lit(3), "spans": F.lit("x")}
    docs = written(real.unionByName(strange).unionByName(more).withColumns(clashing), "odd")
    plain = lambda df: sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=repr)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = written(stage(spark, docs, SF), "odd")
        assert out.columns == docs.columns, name
        texts = {r.doc_id for r in out.collect()}
        assert {None, 10_001, 10_003, 10_004, 10_007} <= texts, name
        if name == "secrets":
            assert out.count() == docs.count()
        if name == "jaccard":  # ids 10002, 10005 and 10006 hold the same words
            assert 10_002 in texts and not {10_005, 10_006} & texts and plain(out.where("doc_id = 10002")) == plain(docs.where("doc_id = 10002"))
        docs = out
    packed = dict(corpus_pipeline.STAGES)["packing"](spark, docs, SF)
    rows = packed.collect()
    assert sum(r.piece == 0 for r in rows) == docs.count()
    check_packed(rows, 4096)
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name
