"""The pipeline's stages: each on what the one before kept, its decisions taking effect."""

import hashlib
import os
import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from stratalake.llm.jaccard_join import jaccard_components
from stratalake.sources import stage

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001").replace("sf0.001", "sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = [docs]
    for _, function in pipeline.STAGES[:-1]:
        seen.append(stage(function(spark, seen[-1], SF_DIR)))
        assert seen[-1].columns == docs.columns and 0 < seen[-1].count()
    raw, good, cut, single, mixed = seen
    quality = dict(spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect())
    kept = {r["doc_id"] for r in good.collect()}
    clean = [d for d, q in quality.items() if q == 1]
    assert sum(d in kept for d in clean) > 0.97 * len(clean)
    assert sum(d in kept for d, q in quality.items() if q == 0) < 0.2 * len(quality)
    assert {r["doc_id"] for r in cut.collect()} <= kept
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    groups = dict(jaccard_components(cut).select("doc_id", "component_id").collect())
    assert {r["doc_id"] for r in single.collect()} == {d for d, c in groups.items() if c == d}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert max(times.values()) <= 3 and set(times) <= {r["doc_id"] for r in single.collect()}
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in single.collect()}
    total = sum(words.values())
    assert abs(sum(words[d] * n for d, n in times.items()) - total) < 0.02 * total
    coded = pipeline.STAGES[-1][1](spark, mixed, SF_DIR).collect()
    text = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in single.collect()}
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in coded) == Counter({(d, text[d]): n for d, n in times.items()})


@pytest.mark.parametrize("unrelated", [[], [(7, "some other text that stands here twice under one id")] * 2])
def test_one_of_group_where_ids_are_null_or_repeated(spark, unrelated):
    base = " ".join(f"word{k}" for k in range(60))
    clean = " ".join(f"term{k}" for k in range(60))
    rows = [(None, base + " a"), (None, base + " a"), (None, base + " b")]  # copies without an id
    rows += [(1, "x " + clean), (2, clean), (2, "an unlike text of the same id as a copy")]
    frame = spark.createDataFrame([*rows, *unrelated], "doc_id long, text string")
    out = [tuple(r) for r in pipeline.keep_one_of_group(spark, frame, SF_DIR).collect()]
    nameless = [t for d, t in out if d is None]
    assert len(nameless) == 1 and nameless[0].startswith(base)
    assert sorted(r for r in out if r[0] is not None) == sorted({(1, "x " + clean), rows[5], *unrelated})


ODD = "doc_id long, text string, lang string, source string, n_chars long, of_id int, of_key int, turn int, repeats int, plan int, copy int, cut int, removed_lines int"


def odd_documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, 1, 2, 3, 9, 5, 6, 7, 8, 11) for d, t, s in rows], ODD)


@pytest.mark.parametrize("rows", [[], [(None, None, None), (1, "", "a"), (2, None, "a"), (3, "some words of a text " * 20, "b")]])
def test_stages_take_nulls_empty_tables_and_clashing_names(spark, rows):
    docs = odd_documents(spark, rows)
    for _, stage_of in pipeline.STAGES[1:-1]:
        out = stage_of(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        got = [r.asDict() for r in out.collect()]
        assert all(r["turn"] == 9 and r["removed_lines"] == 11 and r["plan"] == 6 and r["copy"] == 7 for r in got)
        if rows and stage_of is not pipeline.mix:
            assert len(got) == len(rows)
    assert pipeline.keep_quality(spark, docs, SF_DIR).columns == docs.columns
    assert pipeline.encode(spark, docs, SF_DIR).count() == len(rows)


def test_the_mix_takes_what_it_plans_for_texts_of_one_id(spark):
    docs = odd_documents(spark, [(k % 3, f"text {k} " + "word " * (k % 4), "abc"[k % 2]) for k in range(30)])
    sizes = pipeline.mix_sources(docs, pipeline.WEIGHTS, pipeline.MAX_REPEATS).agg({"taken": "sum"}).first()[0]
    out = pipeline.mix(spark, docs, SF_DIR).collect()
    assert sum(len(r["text"].split()) for r in out) == sizes
