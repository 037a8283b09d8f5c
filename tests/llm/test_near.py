"""Near dedup of the pipeline against brute force, and one row of each group of copies."""

import collections
import itertools
import math
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
import xxhash

import corpus_pipeline
from tests.llm.test_operators import ascii_lower, passage, words
from tripgauge.llm import exact, near
from tripgauge.llm.common import table
from tripgauge.llm.simhash import covering_masks

SEVERAL = "/root/testdata/sf0.01"


def plain_shingles(text, n=5):
    w = words(ascii_lower(text))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def edited(text, share, seed):
    r, w = random.Random(seed), text.split()
    return " ".join(x + "z" if r.random() < share else x for x in w)


def plain_print(text):
    counts = collections.Counter(words(ascii_lower(text)))
    ones, total = [0.0] * 64, sum(math.sqrt(n) for n in counts.values())
    for w, n in counts.items():
        h = xxhash.xxh64_intdigest(w.encode(), 42)
        for i in range(64):
            ones[i] += math.sqrt(n) * (h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * ones[i] > total)


def plain_classes(texts, similarity, radius=near.RADIUS):
    """The first of each class, and how many candidates failed."""
    sets, prints = [plain_shingles(t) for t in texts], [plain_print(t) for t in texts]
    root, failed = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                if jaccard(sets[i], sets[j]) >= similarity:
                    root = [root[j] if x == root[i] else x for x in root]
                else:
                    failed += 1
    first = {}
    for i, x in enumerate(root):
        first.setdefault(x, i)
    return sorted(first.values()), failed


def test_masks_keep_enough_bits():
    for radius in (1, 2, 3, 4, 5, near.RADIUS):
        assert min((m % (1 << 64)).bit_count() for m in covering_masks(radius)) >= 20
    with pytest.raises(ValueError):
        covering_masks(7)


def test_a_batch_is_marked_one_text_at_a_time():
    texts = pd.Series([passage(s % 20, 500) for s in range(1000)] + [None, ""])
    size = sum(len(t or "") for t in texts)
    near.text_marks(texts[:5])
    tracemalloc.start()
    marks = near.text_marks(texts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < size / 2
    assert [int(v) % (1 << 64) for v in marks["fp"][:20]] == [near.word_print(near.words_of(t)) for t in texts[:20]]
    assert marks["node"].nunique() == 21 and marks["fp"].tolist()[-2:] == [0, 0]


@pytest.mark.parametrize("block", [3, 512])
@pytest.mark.parametrize("similarity", [0.8, 0.97])
def test_classes_are_those_of_brute_force(spark, similarity, block):
    texts = [edited(passage(s, 700), e, 10 * s + k) for s in range(6) for k, e in enumerate([0, 0, .001, .002, .004, .006, .01])]
    texts += ["", None, "a", "A"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    first, failed = plain_classes(texts, similarity)
    assert (failed > 0) == (similarity > 0.9)
    kept = near.near_dedup(docs, similarity=similarity, block=block)
    assert sorted(r["doc_id"] for r in kept.collect()) == first


def test_many_that_resemble_one_text_and_many_that_fail(spark):
    r = random.Random(8)
    base, other = passage(31, 300).split(), passage(32, 300).split()
    texts = [" ".join(base)]
    for k in range(1000):  # a hub: each copy has one word of its own
        w = list(base)
        w[r.randrange(len(w))] = f"own{k}"
        texts.append(" ".join(w))
    for k in range(150):  # one template, filled in differently: alike by words, not by shingles
        w = list(other)
        for i in range(0, 300, 20):
            w[i] = f"fill{r.randrange(40)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = sorted(x["doc_id"] for x in near.near_dedup(docs, block=64).collect())
    sets, prints = [plain_shingles(t) for t in texts], [plain_print(t) for t in texts]
    root = list(range(len(texts)))
    failed = 0
    for i in range(1001, len(texts)):
        for j in range(1001, i):
            if (prints[i] ^ prints[j]).bit_count() <= near.RADIUS:
                if jaccard(sets[i], sets[j]) >= .8:
                    root = [root[j] if x == root[i] else x for x in root]
                else:
                    failed += 1
    assert failed > 1000
    assert kept == [0, *sorted({root.index(root[i]) for i in range(1001, len(texts))})]


def test_recall_of_the_stage(spark):
    """Of all pairs of different texts of that similarity; copies are always found."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    ids = {" ".join(words(ascii_lower(r["text"]))): r["doc_id"] for r in docs.collect()}
    rows = {i: plain_shingles(t) for t, i in ids.items()}
    places = collections.defaultdict(list)
    for i, found in rows.items():
        for s in found:
            places[s].append(i)
    # A shingle of more texts is a shared passage; similar texts share others as well.
    shared = collections.Counter(p for found in places.values() if len(found) < 60 for p in itertools.combinations(found, 2))
    pairs = [p for p in shared if jaccard(rows[p[0]], rows[p[1]]) >= near.SIMILARITY]
    group = {r["doc_id"]: r["group"] for r in near.near_rows(docs).collect()}
    assert len(pairs) > 40 and sum(group[a] == group[b] for a, b in pairs) >= 0.9 * len(pairs)
    # Every class hangs together by links of that similarity.
    classes = collections.defaultdict(list)
    for i in rows:
        classes[group[i]].append(rows[i])
    for sets in classes.values():
        left, queue = sets[1:], sets[:1]
        while queue:
            at = queue.pop()
            reached = [s for s in left if jaccard(at, s) >= near.SIMILARITY]
            left, queue = [s for s in left if s not in reached], queue + reached
        assert not left


@pytest.mark.parametrize("name", ["exact dedup", "near dedup"])
def test_stages_keep_one_row_of_each_group(spark, name):
    a, b, c = passage(21, 30), passage(22, 30), passage(23, 30)
    rows = [(1, a, "x"), (1, a, "y"), (1, a, "y"), (2, a, "x"), (None, a, "x"), (None, b, "x"), (None, b, "x"),
            (3, c, "x"), (3, c.replace(" ", "  "), "x"), (4, "x " + c, "x"), (None, None, None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own string").repartition(4)
    kept = dict(corpus_pipeline.STAGES)[name](spark, docs, SEVERAL)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert all(tuple(r) in rows for r in got)
    norm = collections.Counter((r["doc_id"], " ".join((r["text"] or "").split())) for r in got)
    # The text of id 4 has another first shingle: 26 of 27 are shared, which is above 0.8.
    want = {(1, a), (None, b), (3, c), (None, "")} | ({(4, "x " + c)} if name == "exact dedup" else set())
    near_by = {(4, "x " + c)} if (plain_print(c) ^ plain_print("x " + c)).bit_count() > near.RADIUS else set()
    assert set(norm) == want | near_by and set(norm.values()) == {1}


def test_similar_sets_share_one_of_their_rarest(spark):
    r = np.random.default_rng(5)
    common = np.unique(r.integers(0, 1 << 63, 200, np.uint64))
    counts = r.integers(4, 50, len(common))
    tried = 0
    for _ in range(3000):
        n, similarity = int(r.integers(1, 60)), float(r.choice([0.5, 0.8, 0.9, 1.0]))
        a = np.unique(np.concatenate([r.choice(common, int(n * r.random())), r.integers(0, 1 << 63, n, np.uint64)]))
        b = np.unique(np.concatenate([a[r.random(len(a)) < r.choice([0.75, 0.9, 0.97])], r.integers(0, 1 << 63, int(r.integers(4)), np.uint64)]))
        both = len(np.intersect1d(a, b))
        if both >= similarity * (len(a) + len(b) - both) and both:
            tried += 1
            for known, seen in ((common, counts), (common[:0], counts[:0])):
                assert len(np.intersect1d(near.rarest(a, similarity, known, seen), near.rarest(b, similarity, known, seen)))
    assert tried > 500
    assert not len(near.rarest(common[:0], 0.8, common, counts))
    # Common ones come last, the most common at the end.
    own = np.sort(r.integers(0, 1 << 63, 3, np.uint64))
    got = near.rarest(np.unique(np.concatenate([own, common])), 0.5, common, counts)
    assert got[:3].tolist() == own.tolist() and len(got) == len(common) + 3 - math.ceil(0.5 * (len(common) + 3)) + 1
    ranks = counts[np.searchsorted(common, got[3:])]
    assert (np.diff(ranks) >= 0).all() and ranks[-1] <= np.median(counts) + 1


def test_a_large_region_of_unlike_texts_is_parted(spark, monkeypatch):
    """Texts that are close by their words alone leave a large region before its blocks meet."""
    r = random.Random(3)
    base = passage(41, 400).split()
    texts = []
    for k in range(200):  # the same words in other orders: one region, no two alike
        r.shuffle(base)
        texts.append(" ".join([*base, f"own{k}"]))
    copies = [edited(texts[i], .01, i) for i in range(0, 200, 10)]
    foot = " and at the foot of each the same line of words stands here"
    docs = spark.createDataFrame(list(enumerate(t + foot for t in texts + copies)), "doc_id long, text string").repartition(4)
    moved = []

    def stage(df, name, old=near.stage):
        out = old(df, name)
        moved.append((name, out.count()))
        return out

    monkeypatch.setattr(near, "stage", stage)
    kept = sorted(x["doc_id"] for x in near.near_dedup(docs, block=16).collect())
    assert kept == plain_classes([t + foot for t in texts + copies], near.SIMILARITY)[0]
    assert dict(moved)["near-texts"] > 200
    pairs = len(texts + copies) - len(kept)
    assert pairs > 10 and dict(moved).get("near-parted") == 2 * pairs
    # Blocks settled these alone and met no others.
    assert [n for name, n in moved if name == "near-heads"] == [2 * pairs]
    assert not any(n for name, n in moved if name in ("near-open", "near-across"))


def test_no_rows_or_copies(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    for dedup in (lambda d: exact.exact_dedup(d, single=True), near.near_dedup):
        assert dedup(docs).count() == 2 and dedup(docs.filter("false")).count() == 0
