"""The numbered operators against brute force, on a table of odd rows and on the smallest given tables."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from checks.compare import _bag, tables
from stratalake.llm import bpe, fingerprints, jaccard_join, line_dedup, mixing, quality_classifier, quality_rules, sharding, url_filter, warc
from stratalake.llm.components import connected_components
from stratalake.llm.jaccard_join import jaccard_components
from stratalake.llm.queries import ORACLE, QUERIES, URL_RULES
from stratalake.sources import scratch_path

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, place string"
PASSAGE = " ".join(f"word{k}" for k in range(60))
LONG = " ".join(f"w{k % 997}x{k}" for k in range(40_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing extra columns."""
    rows = [
        (1, "one two three four five six", "en", "a"),
        (1, "one two three four five six", "en", "a"),
        (2, "ONE two three four\tfive six", "en", "b"),
        (3, None, None, None),
        (None, "a text without an id, and with some words", "en", None),
        (4, "", "de", "b"),
        (5, " \t\n ", "de", "c"),
        (6, LONG, "en", "a"),
        (7, LONG + " end", "en", "a"),
        (8, f"own first line\n{PASSAGE}\nown last line", "fr", "c"),
        (9, f"another start\n{PASSAGE}\nanother end", "fr", "c"),
        (9, "same id, other text: it's 's 're \u00e9\u00e8 1\u0663 \u2028 x" + "  \n" * 3, "fr", "c"),
        (10, "tiny", "es", "d"),
        (11, "x" * 5000, "es", "d"),
    ]
    return spark.createDataFrame([(*r, 7, "s", "t", "p") for r in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def given(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("given tables are not here")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def texts_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def least_capacity(sizes, n):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, None
        room = middle
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= n else (middle + 1, high)
    return low


@pytest.mark.parametrize("n", [3, 7])
def test_sharding(spark, odd, none, given, n):
    assert sharding.shard_documents(none, n).count() == 0
    for frame in (odd, given):
        texts = texts_of(frame)
        out = sharding.shard_documents(frame, n).collect()
        want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
        slots = defaultdict(list)
        for r in out:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
        keyed = frame.select(F.xxhash64("text").alias("key"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).alias("size"))
        groups = keyed.groupBy("key").agg(F.sum("size").alias("total"))
        best = least_capacity([r["total"] for r in groups.orderBy("key").collect()], n)
        capacity, _ = sharding.minimax_cuts(groups, n)
        assert capacity == best
        loads = Counter()
        for r in out:
            loads[r["shard"]] += r["size"]
        assert max(loads.values()) <= best


def test_splits_until_the_capacity_is_exact(spark):
    groups = spark.range(3000).select(F.shiftright(F.xxhash64("id"), 20).alias("key"), (F.col("id") % 97 + 1).alias("total"))
    sizes = [r["total"] for r in groups.orderBy("key").collect()]
    assert sharding.minimax_cuts(groups, 11)[0] == least_capacity(sizes, 11)


def brute_components(texts, percent=80):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for doc, text in texts:
        words = WORD.findall((text or "").translate(lower))
        sets.append((doc, frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, (_, a)), (j, (_, b)) in combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (doc, _) in enumerate(sets):
        members[root(i)].append(doc)
    lowest = {k: min((d for d in m if d is not None), default=None) for k, m in members.items()}
    return Counter((d, len(s), lowest[root(i)] if s else d) for i, (d, s) in enumerate(sets))


def test_jaccard_components(odd, none, given):
    assert jaccard_components(none).count() == 0
    for frame in (odd, given):
        assert Counter(map(tuple, jaccard_components(frame).collect())) == brute_components(texts_of(frame))


def test_near_copies_in_a_large_group(spark):
    rng = np.random.default_rng(5)
    base = [f"v{k}" for k in range(120)]
    texts = []
    for i in range(400):
        words = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 6)):
            words[k] = f"e{rng.integers(0, 9)}"
        texts.append((i, " ".join(words)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    assert Counter(map(tuple, jaccard_components(frame).collect())) == brute_components(texts)


def near_copies(n, families=1):
    """Copies of a text of 120 words, a few of them changed in each; most are linked through others."""
    rng = np.random.default_rng(n)
    texts = []
    for i in range(n):
        words = [f"f{i % families}v{k}" for k in range(120)]
        for k in rng.integers(0, 120, rng.integers(0, 4)):
            words[k] = f"e{rng.integers(0, 99)}"
        texts.append((i, " ".join(words)))
    return texts


def test_visits_grow_as_a_group_of_near_copies(spark, monkeypatch):
    plain, visits = jaccard_join._links, {}
    for n in (1500, 6000):
        seen = spark.sparkContext.accumulator(0)

        def counting(percent, seen=seen):
            def run(batches):
                def counted():
                    for batch in batches:
                        seen.add(batch.num_rows)
                        yield batch

                yield from plain(percent)(counted())

            return run

        monkeypatch.setattr(jaccard_join, "_links", counting)
        texts = near_copies(n)
        frame = spark.createDataFrame(texts, "doc_id long, text string")
        found = Counter(r["component_id"] for r in jaccard_components(frame).collect())
        assert max(found.values()) > 0.75 * n  # those with three changes are linked with few
        visits[n] = seen.value
    assert visits[6000] < 6 * visits[1500]


@pytest.mark.parametrize("crowd, sets", [(4, 8), (64, 16)])
def test_dealing_groups_anew_loses_no_link(spark, monkeypatch, crowd, sets):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", sets)
    rng = np.random.default_rng(crowd)
    texts = near_copies(300, 3)
    for i in range(300, 400):  # farther copies, some of which link two others
        words = [f"f{i % 3}v{k}" for k in range(120)]
        for k in rng.integers(0, 120, 3 + i % 5):
            words[k] = f"h{rng.integers(0, 9)}"
        texts.append((i, " ".join(words[: 120 - i % 7])))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    assert Counter(map(tuple, jaccard_components(frame).collect())) == brute_components(texts)


def test_block_pairs_leave_out_blocks_of_one_component():
    rows = [(t, p, 256 * b + 3) for t in (1, 2) for p, b in ((5, 1), (5, 2), (7, 3), (9, 9))]
    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    whole = pa.record_batch(columns, ["token", "part", "block"])
    want = {(x, y): 2 for x, y in ((1, 3), (2, 3), (1, 9), (2, 9), (3, 9))}
    for cut in (8, 3, 1):
        found = Counter()
        for made in jaccard_join._block_pairs(whole.slice(k, cut) for k in range(0, 8, cut)):
            for r in made.to_pylist():
                found[r["a"] >> 8, r["b"] >> 8] += r["shared"]
        assert found == want


def test_texts_without_an_id_meet_their_own_sets_only(spark, monkeypatch):
    texts = [" ".join(f"g{g}w{k}" for k in range(60)) + f" end{i}" for g in range(6) for i in range(3)]
    frame = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    opened = spark.sparkContext.accumulator(0)
    plain = jaccard_join._open_sets

    def counting(batches):
        def seen():
            for batch in batches:
                opened.add(batch.num_rows)
                yield batch

        return plain(seen())

    monkeypatch.setattr(jaccard_join, "_open_sets", counting)
    groups = jaccard_join.jaccard_groups(frame).collect()
    assert 0 < opened.value <= len(texts)
    assert len({r["first_key"] for r in groups}) == 6


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(0, 60) if k % 10 != 9] + [(5, 105), (105, 25), (7, 7)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert out[105] == out[29] == out[0] == 0 and out[39] == 30 and 7 in out


def test_fingerprints(odd, none, given):
    assert fingerprints.fingerprint_documents(none).count() == 0
    for frame in (odd, given):
        texts = sorted(texts_of(frame), key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
        want = Counter()
        for k, (doc, text) in enumerate(texts):
            text, following = text or "", texts[(k + 1) % len(texts)][1] or ""
            edited = fingerprints.edit(text, following)
            prints = fingerprints.digests([t.encode() for t in (text, edited, following)])
            near = fingerprints.likeness(prints[[0, 0]], prints[1:])
            want[(doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), *(p.tobytes().hex() for p in prints[:2]), *near)] += 1
        assert Counter(map(tuple, fingerprints.fingerprint_documents(frame).collect())) == want


def test_one_document_is_its_own_next(spark):
    row = fingerprints.fingerprint_documents(spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")).first()
    assert (row["n_chars"], row["edited_sha256"], row["near_next"]) == (8, hashlib.sha256(b"abcdefab").hexdigest(), 1.0)


def test_mixing(spark, odd, none, given):
    assert mixing.mix_sources(none).count() == 0
    out = mixing.mix_sources(odd).collect()
    assert len(out) == odd.count() and all(r["taken"] == r["size"] * r["repeats"] <= 3 * r["size"] for r in out)
    sizes = Counter(len(WORD.findall(t or "")) for _, t in texts_of(odd))
    assert Counter(r["size"] for r in out) == sizes
    targets = {r["source"]: r["target"] for r in out}
    assert sum(targets.values()) == pytest.approx(sum(r["size"] for r in out))
    again = mixing.mix_sources(odd.repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_mixing_agrees_with_sql(spark, given):
    cursor = tables(SF_DIR).execute(ORACLE["op4_mixing"])
    columns = [d[0] for d in cursor.description]
    got = QUERIES["op4_mixing"](spark, SF_DIR)
    assert sorted(columns) == sorted(got.columns)
    assert _bag(got.columns, got.collect()) == _bag(columns, cursor.fetchall())


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.tiktoken")


def test_bpe(spark, odd, none, given, vocabulary):
    import public_tokenizers
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(vocabulary), special_tokens={})
    assert bpe.bpe_documents(none, vocabulary).count() == 0
    for frame in (odd, given):
        out = bpe.bpe_documents(frame, vocabulary).collect()
        want = Counter((d, tuple(known.encode_ordinary(t or "")), (t or "").encode()) for d, t in texts_of(frame))
        assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in out) == want
    coded = odd.filter("doc_id = 2").select(bpe.bpe_encode("text", vocabulary).alias("e")).select("e.*")
    piece = bpe.bpe_decode_pieces(F.col("ids"), F.col("pieces"), F.lit(1), F.lit(2), vocabulary)
    assert bytes(coded.select(piece.alias("p")).first()["p"]) == b" two three"


def test_bpe_boundaries(vocabulary):
    import random

    import public_tokenizers
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(vocabulary), special_tokens={})
    rng = random.Random(3)
    letters = list("abstmdrvel'''   \n\t1\u0663\u00e9\u6f22!.\u3000\u2009\u2167\u00bd\x1c\x85\0")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 3000, " " * 500, "'" * 77, "x'll've're's't 'll  re"]
    ids = bpe._encoded(pa.array(texts), vocabulary).field("ids").to_pylist()
    assert ids == [known.encode_ordinary(t) for t in texts]


def test_urls(spark, none):
    urls = [
        "https://WWW.Example.com/en/1", "http://a.example.com/en/x?y", "http://example.com/de/#t", "http://b.net/es/1",
        "http://net/fr/", "http://notnet/fr/", "http://x.org", "no scheme", "", None, "://", "http://h.com?x://y/z",
        "http://x.org/" + "a" * 20_000,
    ]
    frame = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    weights = url_filter.fit_url_model(url_filter.sample_url_labels(spark))
    out = {r["page_id"]: r for r in url_filter.filter_urls(frame, URL_RULES, weights).collect()}
    for k, url in enumerate(urls):
        found = re.search("://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1].lower(), found[2]) if found else ("", "")
        fits = [
            (len(h + p), v, h + p) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        rule = max(fits)[2] if fits else None
        assert (out[k]["host"], out[k]["path"], out[k]["rule"]) == (host, path, rule)
        assert out[k]["verdict"] == (max(fits)[1] if fits else "block" if out[k]["score"] >= 0.5 else "allow")
    assert url_filter.filter_urls(frame.limit(0), URL_RULES, weights).count() == 0
    judged = spark.createDataFrame([(1, "http://free-spam-casino.org/x"), (2, "http://museum-library.org/x")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.filter_urls(judged, (("allow", "q", "/"),), weights).orderBy("page_id").collect()] == ["block", "allow"]
    nothing = url_filter.fit_url_model(url_filter.sample_url_labels(spark).limit(0), steps=2)
    assert set(nothing) == {0.0}


def test_urls_of_hosts_the_table_does_not_hold(spark):
    blocked = """royal-casino-vip lucky-roulette24 hot-escorts nude-pics adult-store cheap-viagra pills-express adtracker
        ads-deliver banner-exchange spam-network backlink-shop phishing-kit payday-now cracked-warez torrentz-hub replica-bags
        gambling-den cannabis-store sugar-dating keygens-vault clickbait-hq slotsmania betsports pornhouse"""
    clean = """harbour-lights village-church thornton chess-club weather-report astronomy dentist-office railway-times
        birdwatching violin-lessons stonewall-farm cheese-maker kindergarten geology-notes lighthouse ferry-timetable
        local-history tennis-club translation-bureau bridge-works mathematics-help honey-bees wildflowers city-theatre old-maps"""
    named = {w for kinds in (url_filter.BLOCKED_WORDS, url_filter.ALLOWED_WORDS) for row in kinds.values() for w in row.split()}
    assert not named & {*blocked.split(), *clean.split()}
    rows = [(f"https://{shape.format(h)}", h in blocked.split()) for h in (blocked + " " + clean).split() for shape in ("www.{}.com/", "{}.org/a/12.html")]
    rows += rows[:5]  # repeated rows are judged alike
    frame = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    weights = url_filter.fit_url_model(url_filter.sample_url_labels(spark))
    found = {r["page_id"]: r for r in url_filter.filter_urls(frame, (), weights).collect()}
    assert all(found[k]["score"] == found[100 + k]["score"] for k in range(5))
    caught = sum(found[k]["verdict"] == "block" for k in range(100) if rows[k][1])
    wrong = sum(found[k]["verdict"] == "block" for k in range(100) if not rows[k][1])
    assert caught >= 20 and wrong <= 3


def test_warc(spark):
    rows = [(k, f"http://x/{k}\r\nX", t) for k, t in enumerate(["small", "é" * 700, "é" * 700, "", None, "b" * 200_001, "small"])]
    rows += [(9, None, "é" * 700), (9, None, "é" * 700), (None, "u", "é" * 700)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    root = scratch_path(spark, "warc-test")
    out = warc.archive_pages(spark, pages, root).collect()
    want = Counter()
    for k, _, t in rows:
        raw = (t or "").encode()
        copy = t == "é" * 700 and k != 9
        want[(k, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if copy else "response", 9 if copy else None)] += 1
    assert Counter(map(tuple, out)) == want
    manifest = warc.write_warc(warc.record_chunks(pages), root)
    chunks = warc.read_warc(manifest, root).filter("page_id = 5").orderBy("chunk_no").collect()
    assert b"".join(bytes(r["payload"]) for r in chunks) == b"b" * 200_001 and len(chunks) > 3
    for k, r in enumerate(chunks):
        so_far = b"".join(bytes(x["payload"]) for x in chunks[: k + 1])
        assert (r["running_sha1"], r["payload_bytes"]) == (hashlib.sha1(so_far).hexdigest(), len(so_far))
    assert warc.archive_pages(spark, pages.limit(0), root).count() == 0


def test_line_dedup(odd, none, given):
    assert line_dedup.dedup_lines(none).count() == 0
    out = {(r["doc_id"], r["removed_lines"]): r for r in line_dedup.dedup_lines(odd).collect()}
    cut = out[(9, 1)]
    assert cut["text"] == "another start\nanother end" and cut["earlier_docs"] == [8] and cut["size"] == "s"
    assert [tuple(s) for s in cut["removed_spans"]] == [(1, 2)]
    assert sum(k[1] > 0 for k in out) == 1  # one line alone, or less than 50 words, stays
    before = dict(texts_of(given))
    after = {r["doc_id"]: r for r in line_dedup.dedup_lines(given).collect()}
    assert set(after) == set(before)
    first, left = {}, {}
    for doc in sorted(before):
        lines = before[doc].split("\n")
        gone = {i for s in after[doc]["removed_spans"] for i in range(s["first"], s["after"])}
        assert after[doc]["text"] == "\n".join(x for i, x in enumerate(lines) if i not in gone)
        assert all(left.get(lines[i], doc) < doc for i in gone)  # each is still in an earlier document
        for i, x in enumerate(lines):
            if i not in gone:
                left.setdefault(x, doc)
        kept = after[doc]["text"].split("\n")
        for a in range(len(kept)):
            run, words = [], 0
            for x in kept[a:]:
                run.append(x)
                words += len(WORD.findall(x))
                if words >= 50:
                    assert first.setdefault(tuple(run), doc) == doc
                    break


def test_patience():
    a, b = [1, 2, 3, 4, 5, 9, 9], [2, 3, 9, 9, 4, 5, 7]
    found = line_dedup.patience_matches(a, b)
    assert all(a[i] == b[j] for i, j in found) and found == sorted(found)
    assert {(1, 0), (2, 1), (3, 4), (4, 5)} <= set(found)
    assert line_dedup.patience_matches([], [1]) == [] and line_dedup.patience_matches([1, 1], [1, 1]) == [(0, 0), (1, 1)]


def brute_common(a, b, words, least):
    """Lines with words that are in a run of both texts with so many words."""
    found = set()
    for i in range(len(b)):
        for j in range(len(a)):
            k = 0
            while i + k < len(b) and j + k < len(a) and b[i + k] == a[j + k]:
                k += 1
            if sum(words[i : i + k]) >= least:
                found |= set(range(i, i + k))
    return {i for i in found if words[i]}


def test_repeated_and_swapped_passages_go():
    p, q, w, x, y, u, v, h, k = range(9)
    size = {p: 60, q: 70, h: 2, k: 3}
    cases = [
        ([w, p, x, p, y], [u, p, v], {1}),
        ([x, p, y], [u, p, v, p, w], {1, 3}),
        ([p, h, k], [h, k, p], {2}),
        ([p, q], [q, p], {0, 1}),
    ]
    for a, b, gone in cases:
        spans = line_dedup.common_blocks(a, b, [size.get(z, 5) for z in b], 50)
        assert {i for s in spans for i in range(*s)} == gone
    rng = np.random.default_rng(4)
    for longest in [16] * 400 + [150] * 20:
        kinds = int(rng.integers(2, 12))
        lengths = rng.choice([0, 3, 10, 30, 60], kinds)
        a, b = (rng.integers(0, kinds, rng.integers(1, longest)).tolist() for _ in range(2))
        words = [int(lengths[z]) for z in b]
        spans = line_dedup.common_blocks(a, b, words, 50)
        assert {i for s in spans for i in range(*s) if words[i]} == brute_common(a, b, words, 50)
        assert all(any(a[j : j + t - s] == b[s:t] for j in range(len(a))) and sum(words[s:t]) >= 50 for s, t in spans)


def test_blocks_come_from_the_alignment(monkeypatch):
    a, b, words = [1, 2, 3, 4], [3, 4, 1, 2, 9], [60, 60, 60, 60, 60]
    assert line_dedup.common_blocks(a, b, words, 50) == [(0, 2), (2, 4)]
    real = line_dedup.patience_matches
    monkeypatch.setattr(line_dedup, "patience_matches", lambda a, b, anchors=(): [] if anchors else real(a, b))
    assert len(line_dedup.common_blocks(a, b, words, 50)) == 1  # one alignment cannot hold both
    monkeypatch.setattr(line_dedup, "patience_matches", lambda a, b, anchors=(): [])
    assert line_dedup.common_blocks(a, b, words, 50) == []


def test_heaviest_chain_rises_without_overlap():
    block = line_dedup.Block
    blocks = [block(0, 5, 2), block(5, 0, 4), block(2, 7, 3), block(1, 6, 9)]
    assert line_dedup.heaviest_chain(blocks, [10, 25, 20, 1]) == [blocks[0], blocks[2]]
    assert line_dedup.heaviest_chain([], []) == []


def test_very_repetitive_texts_are_aligned_in_time():
    a, b = [1, 0, 2, 0] * 1500, [0, 2, 0, 1] * 1500 + [3] + [1, 0] * 500
    words = [{0: 0, 1: 30, 2: 30, 3: 60}[x] for x in b]
    gone = {i for s in line_dedup.common_blocks(a, b, words, 50) for i in range(*s)}
    assert {i for i in range(6000) if words[i]} <= gone and 6000 not in gone


def test_clashing_names_and_repeats_of_line_dedup(spark):
    frame = spark.createDataFrame(
        [(1, f"a\n{PASSAGE}", 1, 2, 3, 4), (2, f"b\n{PASSAGE}", 5, 6, 7, 8), (None, None, 0, 0, 0, 0)],
        "doc_id long, text string, cut int, cut_id int, cut_key int, spans int",
    )
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame).collect()}
    assert out[2]["text"] == "b" and [out[2][c] for c in ("cut", "cut_id", "cut_key", "spans")] == [5, 6, 7, 8]
    assert out[None]["text"] is None and out[1]["text"] == f"a\n{PASSAGE}"


def test_archives_are_read_by_many_tasks(spark, given):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    root = scratch_path(spark, "warc-tasks")
    manifest = warc.write_warc(warc.record_chunks(pages).repartition(6), root)
    read = warc.read_warc(manifest, root, with_payload=False)
    assert read.rdd.getNumPartitions() == manifest.count() >= 6


def test_score_is_that_of_plain_python(spark, given):
    import math

    import zstandard

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality_classifier.fit_quality_model(given, labels)
    press = [
        zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(d), level=3, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        for d in (model.good, model.bad)
    ]
    texts = dict(texts_of(given))
    for r in quality_classifier.classify_quality(given, model).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        good, bad = (sum(len(p.compress(raw[i : i + 4096])) for i in range(0, len(raw), 4096)) for p in press)
        gain = (bad - good) / (bad + good) if raw else 0.0
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(gain * model.slope + model.offset))), abs=1e-9)


def test_no_run_of_an_earlier_document_stays(spark):
    p, q = PASSAGE, " ".join(f"term{k}" for k in range(70))
    texts = [f"w\n{p}\nx\n{p}\n{q}", f"u\n{q}\nv\n{p}\nz", f"{p}\nown\n{p}\n{q}\n{p}", f"h\nk\n{q}", f"{q}\nh\nk"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    out = [r["text"] for r in line_dedup.dedup_lines(frame).orderBy("doc_id").collect()]
    assert out == [texts[0], "u\nv\nz", "own", "h\nk", "h\nk"]


def brute_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    inside = {i for k in range(len(words) - 4) if grams[tuple(words[k : k + 5])] > 1 for i in range(k, k + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_quality_rules(spark, odd, none, given):
    assert quality_rules.quality_rules(none).count() == 0
    for frame in (odd, given):
        out = quality_rules.quality_rules(frame).collect()
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert Counter((r["doc_id"], *(r[n] for n in names)) for r in out) == Counter((d, *brute_counts(t)) for d, t in texts_of(frame))
        for r in out:
            assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])


def test_small_groups_are_judged(spark):
    rng = np.random.default_rng(3)

    def plain():
        return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(3, 8))) for _ in range(60))

    def garbage():
        return " ".join("#$%&" * 3 + "".join(rng.choice(list("ABCDEFGHIJ"), 8)) for _ in range(60))

    rows = [("en", "hot", plain()) for _ in range(300)]
    rows += [("en", "small", garbage()) for _ in range(39)]
    rows += [(None, None, garbage()) for _ in range(5)] + [("xx", "rare", plain()) for _ in range(5)]
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    out = sorted(quality_rules.quality_rules(frame).collect(), key=lambda r: r["doc_id"])
    assert all((r["distance"] is None) == r["base_failed"] for r in out)
    assert not any(r["base_failed"] or r["kept"] for r in out[300:344])
    assert all(r["kept"] for r in out[344:]) and sum(r["kept"] for r in out[:300]) > 295
    few = quality_rules.quality_rules(frame.filter("doc_id < 20")).collect()
    assert all(r["distance"] is not None for r in few)


def test_robust_estimates_are_those_of_numpy(spark):
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (400, 5)), rng.normal(8, 0.5, (60, 5))
    names = quality_rules.NAMES
    data = [(1, *map(float, row)) for row in np.concatenate([good, bad])]
    frame = spark.createDataFrame(data, "grp long, " + ", ".join(f"{n} double" for n in names))
    row = quality_rules.robust_estimates(frame).first()
    center = np.array([row[f"m{a}"] for a in range(5)])
    assert np.abs(center - good.mean(axis=0)).max() < 0.25
    factor = np.array([[row[f"l{a}{b}"] if b <= a else 0.0 for b in range(5)] for a in range(5)])
    values = np.concatenate([good, bad])
    d2 = (np.linalg.solve(factor, (values - center).T) ** 2).sum(axis=0) / row["scale"]
    assert (d2[400:] > quality_rules.LIMIT).all() and (d2[:400] > quality_rules.LIMIT).mean() < 0.01


def _plain_distances(points, share=0.75, steps=4):
    """Minimum covariance determinant distances of one group, row by row in numpy."""
    names = list(quality_rules.NAMES)
    spread = np.diag([quality_rules.SPREAD[n] ** 2 for n in names])

    def moments(rows):
        mean = rows.mean(axis=0)
        return mean, (rows - mean).T @ (rows - mean) / len(rows) + spread

    def distances(estimate):
        apart = points - estimate[0]
        return np.einsum("ij,jk,ik->i", apart, np.linalg.inv(estimate[1]), apart)

    def step_of(d2):
        return np.floor(np.log2(d2 + 1e-6) * 32)

    def limit(d2, part):
        return np.sort(step_of(d2))[int(np.ceil(part * len(d2) - 1e-9)) - 1]

    middle = np.sort(points, axis=0)[(len(points) + 1) // 2 - 1]
    ends = []
    for estimate in (moments(points), (middle, spread)):
        for _ in range(steps):
            d2 = distances(estimate)
            estimate = moments(points[step_of(d2) <= limit(d2, share)])
        ends.append(estimate)
    d2 = distances(min(ends, key=lambda e: np.linalg.det(e[1])))
    return d2 / max(1.0, 2 ** ((limit(d2, 0.5) + 1) / 32) / quality_rules.MIDDLE)


def test_kept_is_that_of_numpy(spark, given):
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(given, min_group=1).collect()}
    groups = {}
    for r in given.collect():
        if not (o := out[r["doc_id"]])["base_failed"]:
            lines = [x for x in r["text"].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            upper, words, chars = len(regex.findall(r"\p{Lu}", r["text"])), o["n_words"], o["word_chars"]
            point = (
                (chars + 250) / (words + 50),
                o["n_symbols"] / (o["n_symbols"] + words + 10),
                upper / (chars + 40),
                o["n_dup_lines"] / (len(lines) + 5),
                o["n_repeat_words"] / (words + 10),
            )
            groups.setdefault((r["lang"], r["source"]), []).append((r["doc_id"], point))
        else:
            assert not o["kept"] and o["distance"] is None
    judged = 0
    for rows in groups.values():
        found = _plain_distances(np.array([p for _, p in rows]))
        for (doc_id, _), d2 in zip(rows, found, strict=True):
            assert out[doc_id]["distance"] == pytest.approx(d2, rel=1e-3, abs=1e-6)
            assert out[doc_id]["kept"] == (d2 <= quality_rules.LIMIT) or abs(d2 / quality_rules.LIMIT - 1) < 1e-3
            judged += 1
    assert judged > 50


def test_quality_classifier(spark, odd, none):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    if not os.path.isdir(sf_dir):
        pytest.skip("given tables are not here")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit_quality_model(docs, labels)
    out = quality_classifier.classify_quality(docs, model).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in out]) > 0.9
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    scored = quality_classifier.classify_quality(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert quality_classifier.classify_quality(none, model).count() == 0
    unlabelled = quality_classifier.fit_quality_model(docs, labels.limit(0))
    assert {r["score"] for r in quality_classifier.classify_quality(odd, unlabelled).collect()} == {0.5}


def test_queries_are_registered():
    import __spark_entry__

    assert set(QUERIES) < set(__spark_entry__.queries()) and "pipeline" in __spark_entry__.queries()
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
