"""Scoring texts with a smoothed n-gram model as a weighted backoff automaton.

States are the contexts that were learnt: the root without a word, and every n-gram of fewer than
``order`` words that occurs in the texts learnt from. A state has an arc for every word seen after it, to
the longest context that is left then, and a failure arc to the context without its first
word. A state of count c trusts its arcs by t · c / (c + k); the rest, t · k / (c + k) + 1 - t, is the weight
of the failure arc, by which a word that the state lacks is read further down, and which goes, times
the weight below, into the arcs it has. All weights of a state add up to one. The root has an
arc for every word, at (c + 1) / (N + V + 1). A text is traversed once from left to right, from the
state after an end; the state is carried and logarithms of the weights add up.

The automaton grows with the corpus, so no task holds all of it. Texts are dealt to blocks. A block
asks for the counts of the n-grams it holds and builds the states and arcs its texts can reach.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tripgauge.llm.blocks import co_located, text_blocks
from tripgauge.llm.common import held_out, stage
from tripgauge.llm.keycount import REQUEST, KeySpace, count_keys, mixed, replies_of, requests_table, unsqueezed

BLOCK_BYTES = 6 << 20
# Words of the longest n-grams.
ORDER = 3
# k: how many observations the lower order stands for. t: the most that a state is trusted.
PRIOR = 5.0
TRUST = 0.5
# Requests of n-grams have the number of their words as kind.
WORD = 1
# Bytes of a key beside the bucket's bits. Words are counted exactly but for one in 2^29
# that meets another's key; of longer n-grams that may befall one in 2^21.
WORD_BYTES, GRAM_BYTES = 6, 5
# No word, as it is a space character.
END = b"\n"
STEP = np.uint64(0x9E3779B97F4A7C15)


class BlockText:
    """The tokens of a block's texts in a row, each text closed by the end token."""

    def __init__(self, texts: pa.ChunkedArray):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        flat = lists.flatten()
        parents = np.asarray(pc.list_parent_indices(lists))
        solid = np.asarray(pc.not_equal(flat, ""))
        if not solid.all():  # spaces at the ends leave empty strings
            flat, parents = flat.filter(pa.array(solid)), parents[solid]
        coded = flat.dictionary_encode()
        n = len(lists)
        per_text = np.bincount(parents, minlength=n)
        self.ends = np.cumsum(per_text + 1) - 1
        self.starts = self.ends - per_text
        self.lengths = per_text + 1
        words = coded.dictionary.cast(pa.large_binary()).to_pylist()
        size = int(self.lengths.sum())
        self.token = np.full(size, len(words), np.int64)
        inner = np.ones(size, bool)
        inner[self.ends] = False
        self.token[inner] = np.asarray(coded.indices)
        self.hashes = _hash([*words, END])


def _hash(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


class BlockGrams:
    """The n-grams of a block by their number of words: ``keys[m]`` are the distinct ones, sorted, and
    ``at[m]`` has for every token the number of the one that ends there, -1 where the text hasn't
    so many words yet. A text is preceded by one end."""

    def __init__(self, texts: pa.ChunkedArray, spaces: dict[int, KeySpace]):
        self.text = text = BlockText(texts)
        self.order = max(spaces)
        own = text.hashes[text.token]
        self.keys, of_token = {}, {}
        self.keys[1], number = np.unique(spaces[1].reduce(mixed(text.hashes)), return_inverse=True)
        of_token[1] = number[text.token]
        self.end = int(number[-1])
        self.first: dict[int, np.ndarray] = {}
        place = np.arange(len(own)) - np.repeat(text.starts, text.lengths)
        before = np.roll(own, 1)
        before[text.starts] = text.hashes[-1]
        gram = own
        for m in range(2, self.order + 1):
            # What ends at the token before, its last word, and this one.
            ahead = before if m == 2 else np.roll(gram, 1)
            gram = mixed(ahead * STEP + own)
            real = np.flatnonzero(place >= m - 2)
            self.keys[m], first, number = np.unique(
                spaces[m].reduce(gram[real]), return_index=True, return_inverse=True
            )
            self.first[m] = real[first]
            of_token[m] = np.full(len(own), -1, np.int64)
            of_token[m][real] = number
        self.at = of_token

    def counts(self, m: int, learnt: np.ndarray) -> np.ndarray:
        """How often each of ``keys[m]`` occurs at the tokens that ``learnt`` marks with 1."""
        at = self.at[m]
        real = at >= 0
        return np.bincount(at[real], weights=learnt[real], minlength=len(self.keys[m])).astype(np.int64)


class Automaton:
    """The states and arcs that the texts of ``grams`` can reach, ``counts[m]`` being how often each
    of ``grams.keys[m]`` was learnt, of ``tokens`` in all, ``words`` of them distinct."""

    def __init__(self, grams: BlockGrams, counts: dict[int, np.ndarray], tokens: int, words: int, prior: float, trust: float):
        text, order = grams.text, grams.order
        # States: the root is 0, then the learnt n-grams of each length, -1 for what is none.
        state, n_states = {}, 1
        for m in range(1, order):
            learnt = counts[m] > 0
            state[m] = np.where(learnt, n_states - 1 + np.cumsum(learnt), -1)
            n_states += int(learnt.sum())
        failure = np.zeros(n_states, np.int64)
        back, depth = np.ones(n_states), np.zeros(n_states, np.int8)
        weight = (counts[1] + 1.0) / (tokens + words + 1.0)
        target = np.maximum(state[1], 0) if order > 1 else np.zeros(len(weight), np.int64)
        # Arcs, beginning with those of the root, one per word; ``arc[m]``: which one each n-gram is.
        arc = {1: np.arange(len(weight))}
        sources, weights, targets = [np.zeros(len(weight), np.int64)], [weight], [target]
        n_arcs = len(weight)
        for m in range(2, order + 1):
            first = grams.first[m]
            # Of each n-gram: the one without its last word, whose arc it is, and that without its first.
            context = np.full(len(first), grams.end)
            inner = first > np.repeat(text.starts, text.lengths)[first]
            context[inner] = grams.at[m - 1][first[inner] - 1]
            below = grams.at[m - 1][first]
            seen, source = counts[m - 1][context], state[m - 1][context]
            rest = trust * prior / (seen + prior) + (1.0 - trust)
            weight = trust * counts[m] / (seen + prior) + rest * weight[below]
            real = (counts[m] > 0) & (source >= 0)
            back[source[source >= 0]] = rest[source >= 0]
            depth[state[m - 1][state[m - 1] >= 0]] = m - 1
            if m < order:
                target = state[m]
                held = target >= 0
                failure[target[held]] = np.maximum(state[m - 1][below[held]], 0)
            else:
                target = state[m - 1][below]
            arc[m] = np.where(real, n_arcs - 1 + np.cumsum(real), -1)
            n_arcs += int(real.sum())
            sources.append(source[real])
            weights.append(weight[real])
            targets.append(np.maximum(target[real], 0))
        self.start = int(max(state[1][grams.end], 0)) if order > 1 else 0
        self.sources, self.at = np.concatenate(sources), grams.at
        # The last entry serves tokens that end no n-gram of this length.
        self.arc = {m: np.append(a, -1) for m, a in arc.items()}
        # As views, that are read one by one without a Python object for each entry.
        self.failure, self.back, self.depth = memoryview(failure), memoryview(np.log10(back)), memoryview(depth)
        self.weights, self.targets = memoryview(np.log10(np.concatenate(weights))), memoryview(np.concatenate(targets))

    def score(self, start: int, size: int) -> float:
        """The sum of logarithms along the path of the text of ``size`` tokens from ``start`` on."""
        failure, back, depth, weights, targets = self.failure, self.back, self.depth, self.weights, self.targets
        # The arcs that may be taken at each token: of the root, of states of one word, and so on.
        offered = []
        for m, arc in self.arc.items():
            at = self.at[m][start:start + size]
            offered.append(arc[at].tolist())
        state, total = self.start, 0.0
        words = depth[state]
        for i in range(size):
            arc = offered[words][i]
            while arc < 0:
                total += back[state]
                state = failure[state]
                words -= 1
                arc = offered[words][i]
            total += weights[arc]
            state = targets[arc]
            words = depth[state]
        return total


def score_texts(
    docs: DataFrame,
    modulus: int = 7,
    remainder: int = 2,
    prior: float = PRIOR,
    trust: float = TRUST,
    block_bytes: int = BLOCK_BYTES,
    order: int = ORDER,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``held_out, n_tokens, n_known, train_tokens,
    base_score, score``. Learns n-grams of up to ``order`` words from rows that aren't held out: those
    whose crc32 of the id leaves another remainder; a null id counts as ''. Ids may be of any
    type that casts to text. Null texts are empty: one token, the end. Repeated rows count as often
    as they occur. Without rows to learn from every word is unknown and equally likely."""
    dealt, n = text_blocks(docs.select("doc_id", "text"), block_bytes)
    blocks = co_located(dealt.withColumn("held_out", held_out(F.col("doc_id"), modulus, remainder)), n)
    expected = n * block_bytes // 6
    spaces = {m: KeySpace.for_keys(expected, WORD_BYTES if m == 1 else GRAM_BYTES) for m in range(1, order + 1)}

    def ask(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        grams = BlockGrams(table["text"], spaces)
        learnt = np.repeat(~np.asarray(table["held_out"]), grams.text.lengths).astype(np.int64)
        return requests_table([
            row for m, space in spaces.items() for row in space.pack(m, block, grams.keys[m], grams.counts(m, learnt))
        ])

    requests = blocks.groupBy("block").applyInArrow(ask, REQUEST)
    replies = stage(count_keys(requests), "lm-counts")
    vocabulary = _sum_known(replies.filter(f"block = -1 AND kind = {WORD}"))
    # Every training text's tokens, from the counts the blocks were told of: each key has one owner.
    owned = _owned_total(replies.filter(f"block >= 0 AND kind = {WORD}"))

    id_type = docs.schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, " \
             "base_score double, score double"
    id_arrow = to_arrow_type(id_type)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def traverse(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, [
                id_arrow, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()], strict=True)})
        grams = BlockGrams(table["text"], spaces)
        counts = {m: replies_of(told, m)[0] for m in spaces}
        model = Automaton(grams, counts, owned, vocabulary, prior, trust)
        word, starts, lengths = grams.at[1], grams.text.starts, grams.text.lengths
        known = counts[1][word] > 0
        base = np.log10((counts[1] + 1.0) / (owned + vocabulary + 1.0))[word]
        scores = [model.score(a, size) for a, size in zip(starts.tolist(), lengths.tolist(), strict=True)]
        return pa.table({
            "doc_id": table["doc_id"].combine_chunks().cast(id_arrow),
            "held_out": table["held_out"].combine_chunks(),
            "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat(known.astype(np.int64), starts), pa.int64()),
            "train_tokens": pa.array(np.full(len(starts), owned), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, starts)),
            "score": pa.array(scores, pa.float64()),
        })

    return (
        blocks.groupBy("block")
        .cogroup(replies.filter("block >= 0").groupBy("block"))
        .applyInArrow(traverse, schema)
    )


def _sum_known(rows: DataFrame) -> int:
    def known(batches):
        for batch in batches:
            n = sum(int.from_bytes(unsqueezed(t), "little") for t in batch["totals"].to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return rows.select("totals").mapInArrow(known, "n long").agg(F.sum("n")).head()[0] or 0


def _owned_total(rows: DataFrame) -> int:
    """The sum of all distinct keys' totals."""

    def owned(batches):
        for batch in batches:
            n = 0
            for totals, size, owner in zip(*(batch[c].to_pylist() for c in ("totals", "size", "owner")), strict=True):
                t = np.frombuffer(unsqueezed(totals), f"<u{size}").astype(np.int64)
                n += int(t[np.unpackbits(np.frombuffer(unsqueezed(owner), np.uint8), count=len(t)).astype(bool)].sum())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return rows.select("totals", "size", "owner").mapInArrow(owned, "n long").agg(F.sum("n")).head()[0] or 0
