"""Ranked search, token counts and periodic runs against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from tripgauge.llm import periodic, ranked, token_count
from tripgauge.llm.bpe import _vocabulary
from tripgauge.llm.common import table
from tripgauge.llm.queries import PIECES

SMALL, SEVERAL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD = ["", None, " ", "   ", "\n", "a", "a  b", " a", "a ", "▁", "a▁▁b", "<s> </s><unk><0x0A>", "é é ﬁ Ａ", "x" * 5000,
       "日本語 テキスト", "\x00\x01", "a b c", "👩‍👩‍👧 ok", "A\r\n\tB", "tab\tsep", " \n \n ", "ı İ ẞ"]


# Ranked search

def plain_terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]


def plain_search(docs, items, k=50):
    terms = [plain_terms(t) for _, t in docs]
    held = [t for t in terms if t]
    n_docs, n_terms = len(held), sum(map(len, held))
    df = collections.Counter(t for d in held for t in set(d))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    rows = []
    for item, text in items:
        scored = []
        for (i, _), d in zip(docs, terms, strict=True):
            tf = collections.Counter(d)
            score = sum(
                weight[t] * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * (50 + 50 * len(d) * n_docs // n_terms)))
                for t in set(plain_terms(text)) if t in tf
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        rows += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return rows


def test_terms_are_those_of_the_pattern():
    for text in [*ODD, "Don't-STOP é_É 3.14 ÅÄ"]:
        assert [t.decode() for t in ranked.terms_of(text)] == plain_terms(text)


@pytest.mark.parametrize("docs_a_shard", [3, 8192])
def test_search_equals_brute_force(spark, monkeypatch, docs_a_shard):
    monkeypatch.setattr(ranked, "SHARD_DOCS", docs_a_shard)
    monkeypatch.setattr(ranked, "QUERIES_AT_ONCE", 3)
    r = random.Random(5)
    words = [f"w{i}" for i in range(30)] + ["É", "é", "UP", "up"]
    docs = [(i, " ".join(r.choices(words, weights=range(1, 35), k=r.randint(1, 60)))) for i in range(60)]
    docs += [(i, t) for i, t in enumerate(ODD, 100)] + [docs[3]] * 9 + [(None, docs[4][1])] * 3
    items = [(i, " ".join(r.sample(words, 8))) for i in range(5)] + [(9, None), (10, "unknown"), (11, "w1 w1 W1"), (11, "w2")]
    given = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, rank int")
    asked = spark.createDataFrame(items, "item_id long, text string")
    for k in (4, 50):
        got = [tuple(x) for x in ranked.search(given.repartition(3), asked, k=k).collect()]
        assert sorted(got, key=repr) == sorted(plain_search(docs, items, k), key=repr)
    assert ranked.search(given.filter("false"), asked).count() == 0
    assert ranked.search(given, asked.filter("false")).count() == 0


def test_search_takes_ids_of_any_type(spark):
    for kind, ids in (("string", ["b", "a", None]), ("decimal(20,0)", [Decimal(3), Decimal(1), None])):
        docs = spark.createDataFrame([(ids[0], "x y"), (ids[1], "x y"), (ids[2], "x y"), (ids[0], "z")], f"doc_id {kind}, text string")
        found = ranked.search(docs, spark.createDataFrame([("q", "x")], "item_id string, text string")).orderBy("rank").collect()
        assert [None if r["doc_id"] is None else str(r["doc_id"]) for r in found] == [str(ids[1]), str(ids[0]), None]


def test_pair_bounds_open_fewer_documents():
    r = np.random.default_rng(3)
    shard = ranked.Shard({})
    shard.size = 4000
    for t in range(12):
        docs = np.sort(r.choice(4000, 400 + 150 * t, replace=False)).astype("<u2")
        impacts = r.integers(1, 1000 - 60 * t, len(docs))
        shard.lists[t] = docs, impacts, int(impacts.max())
    order = list(range(11, -1, -1))
    for one, two in zip(order, order[1:], strict=False):
        common, i, j = ranked._common(shard.lists[two][0], shard.lists[one][0])
        shard.pairs[two, one] = common, int((shard.lists[two][1][i] + shard.lists[one][1][j]).max())
    scores = np.zeros(4000, np.int64)
    for docs, impacts, _ in shard.lists.values():
        scores[docs] += impacts
    want = np.lexsort((np.arange(4000), -scores))[:10]
    floor = int(scores[want[-1]])
    opened = {}
    for paired in (True, False):
        shard.opened = 0
        assert shard.best(order, 10, floor, paired) == [(int(d), int(scores[d])) for d in want]
        opened[paired] = shard.opened
    assert opened[True] < opened[False] <= 4000


# Token counts

def test_counts_are_those_of_the_library(spark):
    from sentencepiece import SentencePieceProcessor

    path = _vocabulary(PIECES)
    library = SentencePieceProcessor(model_file=path)
    r = random.Random(1)
    texts = ODD + [row["text"] for row in table(spark, SEVERAL, "documents").collect()]
    texts += ["".join(r.choices(["a", "the", " ", "  ", "\n", "▁", ".", "é", "日", "<s>", "\t", "ing"], k=r.randint(1, 30))) for _ in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["n_tokens"] for x in token_count.count_tokens(docs, PIECES).collect()}
    assert got == {i: len(library.encode(t or "")) for i, t in enumerate(texts)}
    model = token_count.WholeTokens(path)
    assert model.cuts and all(len(library.encode(w)) == 1 for w in model.whole if w)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_count, "MEMORY", 2)
    model = token_count.WholeTokens(_vocabulary(PIECES))
    text = "unlikelyword anotherqqq thirdzzz unlikelyword fourthxxx unlikelyword"
    assert [model.count(text) for _ in range(3)] == [len(model.model.encode(text))] * 3


def test_token_count_query(spark):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=_vocabulary(PIECES))
    for r in entry.queries()["op12_token_counts"](spark, SMALL).join(table(spark, SMALL, "documents"), "doc_id").collect():
        n = len(library.encode(r["text"] or ""))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 4096)


def test_tokens_of_no_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "mine"), (1, "a b", "mine")], "doc_id long, text string, N_TOKENS string")
    assert [r["N_TOKENS"] for r in token_count.count_tokens(docs, PIECES, n_tokens="N_TOKENS").collect()] == [2, 2]
    assert token_count.count_tokens(docs.filter("false"), PIECES, n_tokens="n").count() == 0


# Periodic runs

def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((i, e - i, q) for (i, e), q in found.items())


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_collapsed(words, runs):
    out = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in out)


def looped(seed):
    """Text with repeats of repeats, of short and long periods."""
    r = random.Random(seed)
    words = []
    while len(words) < r.choice([5, 60, 900]):
        part = [r.choice("abc") if r.random() < .5 else f"w{r.randint(0, 9)}" for _ in range(r.choice([1, 2, 3, 7, 15, 16, 17, 31, 32, 40, 70]))]
        if r.random() < .3:
            part = part * r.randint(2, 5) + [r.choice("abc")]
        words += part * r.randint(1, 6) + part[:r.randint(0, len(part))]
    return r.choice([" ", "\n", "  "]).join(words)


def test_runs_equal_brute_force(spark):
    texts = [looped(s) for s in range(120)] + ODD + ["a " * 5, "a " * 6, "a b " * 4, "a b a b a b a", "a a a a a a b " * 9]
    texts += [" ".join(f"u{i}" for i in range(300)) * 1, (" ".join(f"v{i}" for i in range(257)) + " ") * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(docs).collect()}
    for i, t in enumerate(texts):
        words = plain_words(t)
        runs = plain_runs(words)
        assert got[i] == (runs, plain_collapsed(words, runs)), i


def test_pieces_of_a_batch_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(i, looped(i)) for i in range(40)] + [(None, None), (3, looped(3))], "doc_id long, text string")
    whole = sorted(map(repr, periodic.periodic_runs(docs.coalesce(1)).collect()))
    monkeypatch.setattr(periodic, "AT_ONCE", 500)
    assert sorted(map(repr, periodic.periodic_runs(docs.coalesce(1)).collect())) == whole
    assert periodic.periodic_runs(docs.filter("false")).count() == 0


@pytest.mark.parametrize("sf", [SMALL, SEVERAL])
def test_periodic_query_equals_brute_force(spark, sf):
    got = {r["doc_id"]: r.asDict() for r in entry.queries()["op13_periodic"](spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words, h = plain_words(d["text"]), zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        # Long periods are costly to scan for plainly: only where one was put in.
        if h % 10 and n > 1500:
            continue
        runs = plain_runs(words)
        most = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        row = got[d["doc_id"]]
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == (most or (None,) * 3)
        assert row["exponent_milli"] == (1000 * most[1] // most[2] if most else None)
        text = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
    assert planted > 5
