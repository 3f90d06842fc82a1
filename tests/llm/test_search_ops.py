"""Hard negatives, lexical search and decontamination against brute force, on odd rows and given tables."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import _bag, tables
from stratalake.llm import hard_negatives, lexical_search
from stratalake.llm.decontamination import decontaminate, find_windows, item_windows
from stratalake.llm.hard_negatives import mine_hard_negatives
from stratalake.llm.lexical_search import rank_documents
from stratalake.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS = "doc_id long, text string, row long, term string, n_words long, item_id string, bucket int"
ITEMS = "item_id long, text string, row string, words string, len int, win long"
VECTORS = "vec_id long, embedding array<float>, label int, uid long, block int, kind string, w long"
FOREVER = 10**30


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_lexical_search", "op13_decontamination"])
def test_query_equals_its_sql(spark, name):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no given tables")
    result = QUERIES[name](spark, SF_DIR)
    cursor = tables(SF_DIR).execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    expected = _bag(columns, cursor.fetchall())
    assert sorted(columns) == sorted(result.columns)
    assert sum(expected.values()) > 0
    assert _bag(result.columns, result.collect()) == expected


# Hard negatives


def mined(rows, positives=5, negatives=10, every=100):
    """What mine_hard_negatives returns, by comparing every anchor with every row."""
    usable = {
        (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = Counter()
    for anchor in usable:
        if anchor[0] is None or anchor[0] % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(anchor[2], other[2])), FOREVER if other[0] is None else other[0], other[1], k)
            for k, other in enumerate(usable)
            if other != anchor
        )
        for ps, pid, _, _ in [s for s in scored if s[2] == anchor[1]][:positives]:
            fits = [s for s in scored if s[2] != anchor[1] and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:negatives]
            for rank, (ns, nid, _, _) in enumerate(fits, 1):
                out[(anchor[0], None if pid == FOREVER else pid, rank, None if nid == FOREVER else nid, -ps, -ns)] += 1
    return out


def vector_rows(n, d, labels, seed, spread=0.4):
    random.seed(seed)
    centres = [[random.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = random.randrange(labels)
        centre = centres[label if random.random() < 0.6 else random.randrange(labels)]
        rows.append((i, [c * 0.2 + random.gauss(0, spread) for c in centre], label))
    return rows


def mine(spark, rows, every=100, **kwargs):
    frame = spark.createDataFrame([(i, v, label, 7, 8, "k", 9) for i, v, label in rows], VECTORS)
    return Counter(tuple(r) for r in mine_hard_negatives(frame, F.col("vec_id") % every == 0, **kwargs).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK_ROWS", 64)
    rows = vector_rows(700, 20, 4, seed)
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(60)]  # one common vector
    assert mine(spark, rows, every=20) == mined(rows, every=20)


def test_hard_negatives_of_odd_rows(spark):
    rows = [
        (0, [0.5, 0.5, 0.0], 1),
        (0, [0.5, 0.5, 0.0], 1),  # repeated
        (0, [0.25, 0.5], 1),  # same id, shorter vector
        (1, [0.5, 0.25, 0.1], 1),
        (2, [0.5, 0.25, 0.1], 1),  # tie
        (None, [0.5, 0.25, 0.1], 1),
        (3, None, 1),
        (4, [0.5, None, 0.1], 1),
        (5, [0.5, float("nan"), 0.1], 1),
        (6, [0.5, float("inf"), 0.1], 1),
        (7, [0.5, 0.5, 0.5], None),
        (8, [], 2),
        (9, [0.3, 0.2, 0.0], 2),
        (10, [0.2, 0.2, 0.0], 2),
        (11, [0.2, 0.2, 0.0], 3),
        (None, [0.2, 0.2, 0.0], 3),
        (12, [-0.5, -0.5, 0.2], 1),
        (13, [1e9, 3.0, 2.0], 5),  # needs eight bytes
        (100, [-0.5, 0.1, 0.2], 9),  # an anchor without others of its label
        (200, [1e6, 1.0, 0.0], 5),
        (300, [0.0, 0.0, 0.0], 2),
    ]
    assert mine(spark, rows) == mined(rows)
    assert mine(spark, rows, positives=1, negatives=1) == mined(rows, 1, 1)


def test_hard_negatives_of_nothing(spark):
    assert mine(spark, []) == Counter()
    assert mine(spark, [(1, [0.5], 1), (2, [0.25], 2)]) == Counter()  # no anchor
    assert mine(spark, [(0, [0.5], 1)]) == Counter()


def test_index_omits_dimensions_and_loses_no_pair():
    rng = np.random.default_rng(5)
    rows = {
        "vec_id": list(range(400)), "label": [0] * 400, "uid": list(range(400)), "wide": [False] * 400,
        "vec": [(rng.normal(0, 40, 40) * np.linspace(2, 0.1, 40)).astype("<i2").tobytes() for _ in range(400)],
    }
    block = hard_negatives._Block(rows)
    asked = block.ints[:30]
    scores = asked @ block.ints.T
    for least in (-10**6, 0, 20_000, 40_000, 10**7):
        a, r, s = block.pairs(asked, np.full(30, least))
        assert sorted(zip(a.tolist(), r.tolist(), s.tolist())) == [
            (i, j, scores[i, j]) for i in range(30) for j in range(400) if scores[i, j] >= least
        ]


# Lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(documents, items, k=10):
    docs = [(i, terms(t)) for i, t in documents]
    docs = [(i, w, Counter(w)) for i, w in docs if w]
    n, length = len(docs), sum(len(w) for _, w, _ in docs)
    df = Counter(t for _, _, c in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in df}
    out = Counter()
    for item, text in set(items):
        scores = []
        for i, words, c in docs:
            m = 10 + (90 * len(words) * n) // length
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, FOREVER if i is None else i))
        for rank, (score, i) in enumerate(sorted(scores)[:k], 1):
            out[(item, rank, None if i == FOREVER else i, -score)] += 1
    return out


def rank(spark, documents, items, **kwargs):
    docs = spark.createDataFrame([(i, t, 1, "t", 2, "x", 3) for i, t in documents], ROWS)
    asked = spark.createDataFrame([(i, t, "r", "w", 1, 2) for i, t in items], ITEMS)
    return Counter(tuple(r) for r in rank_documents(docs, asked, **kwargs).collect())


ODD_DOCS = [
    (1, "The quick brown fox"), (2, "the QUICK brown fox"), (2, "the QUICK brown fox"), (2, "another text of that id"),
    (None, "quick quick fox"), (3, None), (4, ""), (5, " \n.,-"), (6, "É é naïve ÉTÉ 42x"), (7, "fox " * 9000 + "tail"),
    (8, "brown"), (9, "k line \U0001f600 fox"), (None, None),
]
ODD_ITEMS = [
    (1, "quick FOX fox"), (1, "quick FOX fox"), (1, "tail of that id"), (2, None), (3, ""), (None, "brown naïve é"), (4, "absent words"),
    (5, "the"), (6, "\U0001f600 42X line ..."),
]


@pytest.mark.parametrize("kwargs", [{}, {"k": 2, "owners": 1}, {"owners": 7, "bucket_rows": 2, "group_items": 2}])
def test_search_of_odd_rows(spark, kwargs):
    assert rank(spark, ODD_DOCS, ODD_ITEMS, **kwargs) == ranked(ODD_DOCS, ODD_ITEMS, kwargs.get("k", 10))


def test_search_drops_no_document_of_the_result(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i % 300, " ".join(random.choices(words, weights, k=random.randrange(1, 40)))) for i in range(400)]
    docs += [(1000 + i, "w7 w8 w30") for i in range(50)]  # a group of copies that ties
    items = [(i, " ".join(random.choices(words, k=12))) for i in range(12)] + [(99, "w7 w8 w30")]
    got = rank(spark, docs, items, k=4, owners=3, bucket_rows=50, group_items=5)
    assert got == ranked(docs, items, 4)


def test_search_of_nothing(spark):
    assert rank(spark, [], ODD_ITEMS) == Counter()
    assert rank(spark, ODD_DOCS, []) == Counter()
    assert rank(spark, [(1, None), (2, "..")], ODD_ITEMS) == Counter()


def test_an_owner_drops_what_cannot_reach_the_result():
    import pyarrow as pa

    bundles = pa.table({
        "bucket": pa.array([0]), "grp": pa.array([0]), "item": pa.array([7]),
        "terms": pa.array([[1, 2]]), "owners": pa.array([[0, 1]], pa.list_(pa.int32())), "most": pa.array([[900, 50]]),
        **{c: pa.array([[]], pa.list_(pa.int64())) for c in ("rows", "ids", "scores")},
    })
    postings = pa.table({
        "term": pa.array([1] * 4), "row": pa.array([10, 11, 12, 13]), "doc_id": pa.array([0, 1, 2, 3]),
        "added": pa.array([900, 800, 760, 740]),
    })
    kept = lexical_search._owner_stage(0, False, 2)(bundles, postings)
    assert kept["rows"].to_pylist() == [[10, 11, 12]]  # 740 + 50 cannot reach 800


# Decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def cleaned(documents, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for at in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[at : at + window]), set()).add(item)
    out = Counter()
    for i, text in documents:
        w, hit, named = words(text), set(), set()
        for win, ids in windows.items():
            for at in range(len(w) - len(win) + 1):
                if tuple(w[at : at + len(win)]) == win:
                    hit |= set(range(at, at + len(win)))
                    named |= ids
        names = sorted((str(x) for x in named if x is not None), key=lambda x: x.encode())
        out[(i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))] += 1
    return out


def clean(spark, documents, items, **kwargs):
    docs = spark.createDataFrame([(i, t, 1, "t", 2, "x", 3) for i, t in documents], ROWS)
    asked = spark.createDataFrame([(i, t, "r", "w", 1, 2) for i, t in items], ITEMS)
    return Counter(tuple(r) for r in decontaminate(docs, asked, **kwargs).collect())


PASSAGE = " ".join(f"p{i}" for i in range(14))
BENCH = [
    (1, PASSAGE), (1, PASSAGE), (2, "intro " + PASSAGE), (3, "same " * 12), (4, None), (5, " .,"), (None, "no id but eleven words of its own to be found here"),
    (6, "three short words"), (7, "six words make up this item"), (8, "Él É"), (8, "one"), (10, "a b a b a b a b a b a b"),
]
DOCS = [
    (1, f"before, {PASSAGE.upper()}; after"), (1, f"before, {PASSAGE.upper()}; after"), (2, " ".join(PASSAGE.split()[:9])),
    (3, " ".join(PASSAGE.split()[2:12])), (4, "same " * 30), (4, "same " * 9), (None, PASSAGE), (5, None), (6, ""), (7, "?!"),
    (8, "no id but eleven words of its own to be found here"), (9, "three short words three short words three short"),
    (10, "Six-words make_up this item ITEM"), (11, "él É"), (12, "Él É one"), (13, "a b " * 50 + "c " + "b a " * 8),
    (14, "x " * 20_000 + PASSAGE + " y" * 20_000), (15, "p0 p1 p2 p3 p4 x p5 p6 p7 p8 p9"),
]


def test_decontamination_of_odd_rows(spark):
    assert clean(spark, DOCS, BENCH) == cleaned(DOCS, BENCH)
    assert clean(spark, DOCS, BENCH, window=13) == cleaned(DOCS, BENCH, 13)


def test_decontamination_of_random_words(spark):
    random.seed(9)
    vocabulary = [f"v{i}" for i in range(4)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.randrange(0, 16)))) for i in range(40)]
    docs = [(i % 50, " ".join(random.choices(vocabulary, k=random.randrange(0, 120)))) for i in range(80)]
    assert clean(spark, docs, items) == cleaned(docs, items)


def test_decontamination_of_nothing(spark):
    assert clean(spark, [], BENCH) == Counter()
    assert clean(spark, DOCS, []) == cleaned(DOCS, [])
    assert clean(spark, DOCS, [(1, None), (2, "")]) == cleaned(DOCS, [])


def test_windows_without_a_place_leave_before_the_join(spark):
    docs = spark.createDataFrame([(1, "k " * 5000)], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "k k k k k k k k k z")], "item_id long, text string")
    _, found = find_windows(docs, item_windows(asked))
    assert found.count() == 0
