"""Each operator against a plain version of its contract, on rows with nulls, empty and long
texts, ties, repeats and clashing columns, and on no rows."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripgauge.llm import bpe, exact, keycount, lm, mixing, quality, simhash, suffix, topk, toxicity, warc
from tripgauge.llm.common import held_out, table
from tripgauge.llm.components import components
from tripgauge.llm.labels import fit_sample

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, prefix string, mix_size string"


def passage(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(words))


def texts():
    shared = passage(1, 80)
    return [
        None, "", " \t\n", "one", "One", "one two", "one  two", "one\ttwo\n", "ÀB c", passage(2, 3000),
        shared, shared, passage(3, 20) + " " + shared, shared + " " + passage(4, 20), "ab " * 400, "ab " * 300,
        passage(5, 40), passage(5, 40) + " end", passage(6, 500), passage(6, 500).replace("a", "b", 1),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", ["a", "b", None, ""][i % 4], 0, 7, "x", "y") for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], rows[10], (None, "one", None, "a", None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# mixing

def test_mix(docs):
    plan = rows_of(mixing.mix_plan(docs, pieces=2))
    again = rows_of(mixing.mix_plan(docs.repartition(2), pieces=2))
    assert sorted(map(repr, plan)) == sorted(map(repr, again))
    by_source = collections.defaultdict(list)
    for r in plan:
        assert r["mix_size"] == len(words(r["text"])) and 0 <= r["mix_copies"] <= 2 and r["n"] in (7, None)
        by_source[r["source"]].append(r)
    total = sum(r["mix_size"] for r in plan)
    targets = [rs[0]["mix_target"] for rs in by_source.values()]
    assert math.isclose(sum(targets), 1.5 * total)
    for rs in by_source.values():
        assert rs[0]["mix_source_size"] == sum(r["mix_size"] for r in rs)
        taken = sum(r["mix_copies"] * r["mix_size"] for r in rs)
        assert abs(taken - rs[0]["mix_target"]) <= max(r["mix_size"] for r in rs)
    more = docs.withColumns({"mix_start": F.lit("s"), "MIX_copy": F.lit("t"), "n": F.lit("u")})
    mixed = mixing.mix(more, pieces=2)
    assert mixed.columns == more.columns
    assert {(r["mix_start"], r["MIX_copy"], r["n"]) for r in mixed.collect()} == {("s", "t", "u")}
    assert {r["mix_size"] for r in mixed.collect()} <= {"y", None}
    assert mixed.count() == sum(r["mix_copies"] for r in plan)


def test_targets_reshare_until_none_is_above(spark):
    sizes = {"=a": 10, "=b": 1000, "=c": 700, "=d": 0, "~": 90}
    df = spark.createDataFrame(list(sizes.items()), "source_key string, source_size long")
    got = {r["source_key"]: r["target"] for r in mixing.source_targets(df).collect()}
    weights = dict(zip(sorted(sizes), [5, 2, 1, 5, 2]))
    fixed, want, budget = {}, {}, 1.5 * sum(sizes.values())
    while True:
        rest = [k for k in sizes if k not in fixed]
        left = budget - sum(fixed.values())
        want = {k: left * weights[k] / sum(weights[x] for x in rest) for k in rest}
        over = [k for k in rest if want[k] >= 2 * sizes[k]]
        if not over:
            break
        fixed.update({k: 2.0 * sizes[k] for k in over})
    want.update(fixed)
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in sizes)


# exact dedup

@pytest.mark.parametrize("digest_all", [True, False])
def test_exact(docs, digest_all):
    got = rows_of(exact.exact_groups(docs, digest_all=digest_all, prefix_chars=3))
    groups = collections.defaultdict(list)
    for r in docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")].append(r["doc_id"])
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, keep, len(ids), i == keep, digest) for i in ids]
    if not digest_all:
        assert all(r["text_sha256"] for r in got if r["group_size"] > 1)
        want, got = [w[:4] for w in want], [{k: v for k, v in r.items() if k != "text_sha256"} for r in got]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r.values())) for r in got)
    kept = exact.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {w[0] for w in want if w[3]} | {None}


@pytest.mark.parametrize("dedup", [exact.exact_dedup, simhash.simhash_dedup])
def test_dedup_keeps_other_texts_of_an_id_and_clashing_columns(spark, dedup):
    a, b, c = passage(21, 30), passage(22, 30), passage(23, 30)
    rows = [(1, a), (2, b), (3, a), (3, c), (4, None), (5, ""), (None, a), (6, b), (6, b)]
    names = ["dropped_id", "k0", "c1", "len", "own_hash", "fp", "keep_id", "component_id", "a.b"]
    docs = spark.createDataFrame(
        [(*r, *("x" * len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    )
    kept = dedup(docs)
    assert kept.columns == docs.columns
    want = [(1, a), (2, b), (3, c), (4, None), (None, a)]
    assert sorted(map(repr, kept.collect())) == sorted(
        repr(r) for r in docs.collect() if (r["doc_id"], r["text"]) in want
    )


def test_exact_dedup_tells_texts_of_an_id_apart_by_all_their_content(spark):
    head = "x" * 100
    rows = [(1, head + " one"), (2, head + " one"), (2, head + " two")]
    kept = exact.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


# simhash

def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    w = words(ascii_lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    members = collections.defaultdict(list)
    for i, doc in enumerate(ids):
        members[find(i)].append(doc)
    return [min((d for d in members[find(i)] if d is not None), default=None) for i in range(len(ids))]


def test_simhash_classes(docs):
    rows = docs.collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    want = plain_components([r["doc_id"] for r in rows], prints)
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in rows_of(simhash.simhash_classes(docs))]
    assert sorted(map(repr, got)) == sorted(
        repr((r["doc_id"], p, c)) for r, p, c in zip(rows, prints, want, strict=True)
    )


def test_masks_cover_every_pair_within_the_radius():
    masks = [m % (1 << 64) for m in simhash.covering_masks(3)]
    r = random.Random(5)
    for _ in range(3000):
        difference = sum(1 << b for b in r.sample(range(64), 3))
        assert any(m & difference == 0 for m in masks)


@pytest.mark.parametrize("block", [5, 2048])
def test_links_of_hot_buckets(spark, block):
    r = random.Random(9)
    seeds = [r.getrandbits(64) for _ in range(4)]
    prints = {s ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for s in seeds for _ in range(60)}
    prints |= {r.getrandbits(64) for _ in range(60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    df = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(4)
    roots = {x["node"]: x["root"] for x in components(simhash.near_links(df, block=block)).collect()}
    want = plain_components(signed, [p % (1 << 64) for p in signed])
    assert [roots.get(p, p) for p in signed] == want


def test_components_of_a_long_chain(spark):
    n = 300
    chain = [(i * 7919 % n, (i + 1) * 7919 % n) for i in range(n - 1)]
    got = components(spark.createDataFrame([*chain, (1000, 1000), (2000, 2001)], "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {**dict.fromkeys(range(n), 0), 2000: 2000, 2001: 2000}


# top-k

@pytest.mark.parametrize("shard_rows", [10_000, 40, 90])
def test_top_k(spark, shard_rows):
    r = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in r.normal(0, 1, (300, 6)).round(1)]
    vectors[7], vectors[8], vectors[9], vectors[10] = None, [1.0, None], [float("nan")] * 6, [float("inf")] * 6
    vectors[11:20] = [vectors[30]] * 9
    vectors[20], vectors[40] = [], [1e9] * 6
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(None, vectors[0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int").repartition(3)
    data = topk.quantised(df)
    got = collections.defaultdict(list)
    for x in topk.top_k(data, data.filter("vec_id % 20 = 0"), 20, shard_rows).collect():
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    ints = {
        i: [math.floor(64 * x) for x in v] for i, v in enumerate(vectors)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    for q in (i for i in ints if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:20]
        assert sorted(got[q]) == [(k, i, -s) for k, (s, i) in enumerate(scores, 1)]


@pytest.mark.parametrize("kind", [np.float64, object])
def test_leaves_are_opened_best_first_and_no_more(kind):
    """Vectors in tight clusters: boxes prune, and what is found is what all scores give."""
    r = np.random.default_rng(5)
    data = (np.repeat(r.integers(-500, 500, (20, 4)), 50, axis=0) + r.integers(-3, 4, (1000, 4))).astype(kind)
    ids, asked = np.arange(1000), np.arange(0, 1000, 20)
    tree = topk.KDTree(ids, data, leaf_rows=16)
    at, scores, found = tree.search(data[asked], asked, 5, np.full(len(asked), topk.NO_BOUND))
    got = collections.defaultdict(list)
    for q, s, i in zip(at, scores, found, strict=True):
        got[q].append((-int(s), int(i)))
    every = data.astype(np.int64) @ data.astype(np.int64).T
    for q, own in enumerate(asked):
        assert sorted(got[q]) == sorted((-int(every[own, i]), i) for i in range(1000) if i != own)[:5]
    assert tree.opened < tree.offered / 4


# WARC

def test_warc_round_trip(spark):
    html = [None, "", "x", "x", "y" * 99, "y" * 99, "z" * 100, "z" * 100, "é" * 60, "é" * 60, "w" * 50_000, "w" * 50_000]
    rows = [(i, f"http://h/{i}\r\nX: 1", h, "e") for i, h in enumerate(html)] + [(None, None, "z" * 100, "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    folder, index = warc.archive(pages)
    got = {r["record_id"]: r for r in rows_of(warc.read_bundles(index, folder))}
    assert len(got) == len(rows)
    first = {}
    for i, h in enumerate(html):
        body = (h or "").encode()
        r = got[f"urn:page:{i}"]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        again = first.setdefault(body, i) if len(body) >= 100 else i
        assert r["record_type"] == ("response" if again == i else "revisit")
        assert r["refers_to"] == (None if again == i else f"urn:page:{again}")
        assert r["payload"] == (body if again == i else None)
    for r in index.collect():
        headers, _ = warc.read_record(folder, r["bundle"], r["frame"], r["record_start"], r["record_size"])
        assert headers["warc-record-id"] == f"<{r['record_id']}>"


def test_bundle_has_many_frames_and_reads_front_to_back(tmp_path):
    import io

    import zstandard
    from pyarrow import fs

    path = str(tmp_path / "b.warc.zst")
    writer, index, records = None, [], [warc.record(f"r{i}", "u", b"p" * i, "d", None) for i in range(50)]
    writer = warc.BundleWriter(fs.LocalFileSystem().open_output_stream(path, compression=None), frame_bytes=1000)
    for i, data in enumerate(records):
        index += writer.add(f"r{i}", data)
    index += writer.close()
    assert len(writer.frames) > 5 and [r[0] for r in index] == [f"r{i}" for i in range(50)]
    with fs.LocalFileSystem().open_input_file(path) as file:
        assert [(p, r) for _, p, r in warc.seek_table(file)] == writer.frames
    reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(path, "rb").read()), read_across_frames=True)
    assert reader.read() == b"".join(records)


# language model

def plain_model(learnt, order):
    """The probability of a word after the words of a text so far, by its recursive definition."""
    count = collections.Counter()
    for t in learnt:
        for i in range(len(t)):
            for m in range(order):
                # An end comes before the text, and nothing before that.
                if i - m >= -1:
                    count[tuple([b"\n", *t][i - m + 1:i + 2])] += 1
    single = {g: c for g, c in count.items() if len(g) == 1}
    n, v = sum(single.values()), len(single)

    def chance(context, word):
        if not context:
            return (count[word,] + 1) / (n + v + 1)
        lower = chance(context[1:], word)
        return lm.TRUST * (count[*context, word] + lm.PRIOR * lower) / (count[context] + lm.PRIOR) + (1 - lm.TRUST) * lower

    return chance, single, n


@pytest.mark.parametrize("block_bytes,order", [(500, 3), (1 << 20, 1), (1 << 20, 2), (1 << 20, 3), (2000, 4)])
def test_scores(docs, block_bytes, order):
    rows = docs.collect()
    tokens = [ascii_lower(r["text"]).encode().split() + [b"\n"] for r in rows]
    held = [zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 7 == 2 for r in rows]
    chance, count, n = plain_model([t for t, h in zip(tokens, held, strict=True) if not h], order)
    want = []
    for r, t, h in zip(rows, tokens, held, strict=True):
        before = [b"\n", *t]
        base = [math.log10(chance((), w)) for w in t]
        steps = [math.log10(chance(tuple(before[max(0, i + 2 - order):i + 1]), w)) for i, w in enumerate(t)]
        want.append((r["doc_id"], h, len(t), sum((w,) in count for w in t), n, round(sum(base), 6), round(sum(steps), 6)))
    got = [tuple(round(x, 6) if isinstance(x, float) else x for x in r)
           for r in lm.score_texts(docs, block_bytes=block_bytes, order=order).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("kind", ["string", "decimal(20,0)", "int"])
def test_scores_with_ids_of_any_type(spark, kind):
    docs = spark.createDataFrame([(1, "a b a b"), (2, "a b"), (None, None)], "doc_id int, text string")
    got = lm.score_texts(docs.withColumn("doc_id", F.col("doc_id").cast(kind)))
    assert got.schema["doc_id"].dataType.simpleString() == kind
    plain = {r["doc_id"]: r["score"] for r in lm.score_texts(docs).collect()}
    assert {None if r["doc_id"] is None else int(r["doc_id"]): r["score"] for r in got.collect()} == plain


def test_arcs_of_a_state_add_up():
    """What a state's arcs weigh, and what its failure arc passes to words it lacks, make one."""
    import pyarrow as pa

    spaces = {m: keycount.KeySpace(7, 8) for m in (1, 2, 3)}
    grams = lm.BlockGrams(pa.chunked_array([["a b c a b", "b c b a", "c c a b c"]]), spaces)
    counts = {m: grams.counts(m, np.ones(len(grams.at[1]), np.int64)) for m in spaces}
    words = len(counts[1])
    model = lm.Automaton(grams, counts, int(counts[1].sum()), words, lm.PRIOR, lm.TRUST)

    # The last word of each n-gram that is an arc.
    labels = np.full(len(model.targets), -1)
    labels[:words] = np.arange(words)
    for m in (2, 3):
        real = model.arc[m][:-1] >= 0
        labels[model.arc[m][:-1][real]] = grams.at[1][grams.first[m][real]]
    arcs = {(int(s), int(w)): a for a, (s, w) in enumerate(zip(model.sources, labels, strict=True))}
    assert len(arcs) == len(model.targets)

    def chance(state, word):
        arc = arcs.get((state, word))
        return 10 ** model.weights[arc] if arc is not None else 10 ** model.back[state] * chance(model.failure[state], word)

    ends = {model.targets[a] for a, w in enumerate(labels) if w == grams.end}
    for state in range(len(model.failure)):
        if state not in ends or state == model.start:
            unseen = 10 ** _back_to_root(model, state) / (counts[1].sum() + words + 1)
            assert sum(chance(state, w) for w in range(words)) + unseen == pytest.approx(1)


def _back_to_root(model, state):
    return 0 if state == 0 else model.back[state] + _back_to_root(model, model.failure[state])


# repeated byte strings

@pytest.mark.parametrize("block_bytes", [2000, 1 << 20])
def test_repeats(docs, block_bytes):
    rows = docs.collect()
    data = [(r["text"] or "").encode() for r in rows]
    seen = collections.Counter(t[p:p + 200] for t in data for p in range(len(t) - 199))
    want = []
    for r, t in zip(rows, data, strict=True):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 199):
            if seen[t[p:p + 200]] > 1:
                gone[p:p + 200] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        want.append((r["doc_id"], len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix.remove_repeats(docs, block_bytes=block_bytes).drop("kept").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(w[2] for w in want) > 1000


def test_keys_come_back_in_the_order_asked():
    for width in (5, 6, 8):
        space = keycount.KeySpace(7, width)
        hashes = keycount.mixed(np.arange(1, 500, dtype=np.uint64))
        keys = np.unique(space.reduce(hashes))
        rows = space.pack(1, 0, keys, np.ones(len(keys), np.int64))
        assert sum(len(r[4]) for r in rows) == len(keys) == 499
        for (_, bucket, _, data, counts, _), (b, part) in zip(rows, space.buckets(keys), strict=True):
            assert bucket == b and len(keycount.unpacked(data, len(counts))) == len(keys[part])


# quality and toxicity

def labelled(spark):
    r = random.Random(4)
    rows = []
    for i in range(600):
        text = passage(1000 + i, 60)
        good, toxic = i % 3 != 0, i % 5 == 0
        if not good:
            text = " ".join([text.split()[0] + "###"] * 60)
        if toxic:
            text += r.choice([" moron", " M0r0n!", " mоron", " twitter-scum"])
        rows.append((i, text, int(good), int(toxic)))
    rows += [(600, None, 0, 0), (601, "", 0, 0), (602, "x" * 300_000, 0, 0)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string").withColumn("score", F.lit("old"))
    labels = spark.createDataFrame(
        [(i, q, t) for i, _, q, t in rows] + [(None, 1, 1), (9999, 1, 1), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    return docs, labels, {i: (q, t) for i, _, q, t in rows}


def test_an_id_of_very_many_texts_is_bounded(spark):
    ids = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    docs = ids.union(spark.range(100, 150).select("id", F.concat(F.lit("other "), F.col("id"))))
    labels = spark.range(200).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality", "cast(id % 2 AS int) AS toxic")
    for rows in (40, 1000):
        sample = fit_sample(docs, labels, "toxic", rows).collect()
        assert 0 < len(sample) <= rows and len({r["text"] for r in sample}) == len(sample)
    assert np.isfinite(quality.quality_model(docs, labels, 500).cut)


def test_quality_threshold_is_that_of_all_labelled_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    model = quality.quality_model(docs, labels, 60)
    known = docs.join(labels.dropna(), "doc_id").filter(~held_out(F.col("doc_id"), 4, 2)).collect()
    raw = np.sort(model.raw(np.array([quality.features(r["text"]) for r in known], float)))
    bad = sum(r["quality"] != 1 for r in known)
    assert abs(np.searchsorted(raw, model.cut, side="right") - bad) <= 1


def test_quality_moves_features_not_texts(spark, monkeypatch):
    docs, labels, _ = labelled(spark)
    plans, write = [], quality.stage

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(quality, "stage", noted)
    quality.quality_model(docs, labels)
    # Features are measured below the join, so that no text is shuffled for it.
    assert 0 <= plans[0].index("Join") < plans[0].index("ArrowEvalPython")


def test_quality(spark):
    docs, labels, truth = labelled(spark)
    scored = quality.score_quality(docs, quality.quality_model(docs, labels)).collect()
    assert len(scored) == 603 and all(0 <= r["score"] <= 1 for r in scored)
    right = [(r["score"] >= quality.CUT) == truth[r["doc_id"]][0] for r in scored if r["doc_id"] < 600]
    assert sum(right) >= 590


def test_toxicity(spark):
    docs, labels, truth = labelled(spark)
    model = toxicity.toxicity_model(docs, labels)
    scored = toxicity.score_toxicity(docs, model).collect()
    assert len(scored) == 603 and all(0 <= r["score"] <= 1 for r in scored)
    right = [(r["score"] >= 0.3) == truth[r["doc_id"]][1] for r in scored if r["doc_id"] < 600]
    assert sum(right) >= 590


def test_exception_phrases_and_folding():
    model = toxicity.Lexicon({" trash ": 3.0, toxicity.folded_phrase("scum"): 2.0}, (toxicity.folded_phrase("trash can"),))
    assert model.measure("the trash can is full") == (0.0, 5)
    assert model.measure("you trash, the trash can")[0] == 3.0
    assert model.measure("trаsh 5cum ＳＣＵＭ")[0] == 7.0
    assert model.measure("trashy 5 7 scumble") == (0.0, 4)
    assert model.measure(None) == model.measure("  ") == (0.0, 0)


def test_models_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_quality(docs, quality.quality_model(docs, none)).count() == 1
    assert 0 <= toxicity.score_toxicity(docs, toxicity.toxicity_model(docs, none)).head()["score"] <= 1


# BPE

VOCABULARY = "word_bpe_49k.json"


def test_bpe_is_the_librarys(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe._vocabulary(VOCABULARY))
    extra = ["<|endoftext|>a <|startoftext|>", "İΣ ς ǅ é ́a 中文 👍🏽 ②²", "don't 'RE I'm", "a" * 3000, "\x1c\x85x\xa0y"]
    spark = docs.sparkSession
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    got = rows_of(bpe.decode_documents(bpe.encode_documents(every, VOCABULARY), VOCABULARY))
    digests = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
               for r in bpe.token_digests(every, VOCABULARY).collect()}
    assert len(got) == every.count()
    for r in got:
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r["ids"], r["decoded"]) == (ids, decoded)
        packed = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (r["doc_id"], len(ids), packed, hashlib.sha256(decoded.encode()).hexdigest()) in digests


def test_bpe_of_every_character_below_the_fast_paths_bound_is_the_librarys():
    from tokenizers import Tokenizer

    tokenizer, codec = Tokenizer.from_file(bpe._vocabulary(VOCABULARY)), bpe.codec(bpe._vocabulary(VOCABULARY))
    for c in map(chr, range(0x250)):
        for text in (c + "LI", "a" + c + "b", "Al" + c):
            assert codec.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, (hex(ord(c)), text)


# no rows

def test_no_rows(docs):
    none = docs.filter("false")
    for result in [
        mixing.mix(none), exact.exact_groups(none), exact.exact_groups(none, digest_all=True), exact.exact_dedup(none),
        simhash.simhash_classes(none), lm.score_texts(none), suffix.remove_repeats(none),
        bpe.encode_documents(none, VOCABULARY), bpe.token_digests(none, VOCABULARY),
    ]:
        assert result.collect() == []
    spark = docs.sparkSession
    vectors = topk.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(vectors, vectors).collect() == []
    folder, index = warc.archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert index.collect() == [] and warc.read_bundles(index, folder).collect() == []


def test_the_memory_of_a_block_is_bounded():
    r = np.random.default_rng(6)
    texts = [r.integers(97, 105, 5000, dtype=np.uint8).tobytes().decode() for _ in range(400)]
    column = pa.chunked_array([pa.array(texts, pa.string())])
    tracemalloc.start()
    try:
        suffix.Stretches(column, keycount.KeySpace(7, 8), 200, 32)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Sums and windows are 8 bytes each for every byte of text.
    assert peak < 32 * 2_000_000
