"""The pipeline stage by stage, each against a brute-force version on its own input."""
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_mixing_preferences import water
from tests.llm.test_near_dup import plain
from vigil.llm import quality, secret_scan
from vigil.llm.tokens import encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        out.append((name, before.collect(), docs.collect(), docs.columns))
    return {name: rest for name, *rest in out}


def test_columns(outputs):
    assert list(outputs) == ["quality", "near_duplicates", "secrets", "mixing", "packing"]
    for name, (_, _, columns) in outputs.items():
        assert name == "packing" or columns == corpus_pipeline.COLUMNS


def test_quality(spark, outputs):
    before, after, _ = outputs["quality"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rejected = {r.doc_id for r in quality.score(docs, model).collect() if r.predicted == 0}
    assert rejected and {r.doc_id for r in after} == {r.doc_id for r in before} - rejected
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r.doc_id for r in before if labels.get(r.doc_id) == 1]
    assert np.mean([i not in rejected for i in good]) > 0.97


def test_near_duplicates(outputs):
    before, after, _ = outputs["near_duplicates"]
    groups = plain([(r.doc_id, r.text) for r in before], 80)
    assert sorted(r.doc_id for r in after) == sorted({*groups.values()}) and {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_secrets(outputs):
    before, after, _ = outputs["secrets"]
    texts = {r.doc_id: r for r in after}
    assert set(texts) == {r.doc_id for r in before}
    for r in before:
        spans = sorted((m.start(), n, m.end()) for n, rule in enumerate(secret_scan.RULES) for m in rule.regex.finditer(r.text)
                       if m.end(rule.group) - m.start(rule.group) >= rule.least)
        if not spans:
            assert texts[r.doc_id] == r
        else:
            assert not any(r.text[s:e] in texts[r.doc_id].text for s, _, e in spans) and texts[r.doc_id].n_chars == len(texts[r.doc_id].text)


def test_mixing(outputs):
    before, after, _ = outputs["mixing"]
    copies, size = Counter(r.doc_id for r in after), {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in before}
    assert max(copies.values()) <= 2 and set(copies) <= set(size)
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += size[r.doc_id]
        taken[r.source] += copies[r.doc_id] * size[r.doc_id]
    want = water(sizes)
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 5 for s in want)


def test_packing(outputs):
    before, after, _ = outputs["packing"]
    enc = encoder("byte_bpe_50k.json")
    assert sum(r.length for r in after) == sum(len(enc(r.text)) + 1 for r in before)
    used = Counter()
    for r in after:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and sum(used.values()) > 0.95 * 2048 * len(used)


def test_run_equals_the_stages(spark, outputs):
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.doc_tokens) for r in got.where("start = 0").collect()) == Counter((r.doc_id, r.doc_tokens) for r in outputs["packing"][1] if r.start == 0)


def test_stages_on_odd_rows(spark):
    text = "several words that are good enough to stay here password=abcdefghijklmnop "
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, text, "en", None, 3), (None, None, "en", "a", 1), (3, text * 3, "en", "a", 9), (3, text * 3, "en", "a", 9),
            (4, text * 3, "en", "b", 9), (5, "word " * 30000, "en", "b", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], schema + ", length int, spans string")
    for case in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, case, SF)
            n = out.count()
            assert (n == 0) == (case.isEmpty()) and (name == "packing" or out.columns == corpus_pipeline.COLUMNS)
