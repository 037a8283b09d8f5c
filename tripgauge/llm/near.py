"""Near-duplicates by similarity of word shingles, candidates by covering hashing.

A text's fingerprint is made of its words, each by the square root of how often it occurs: an edited
word moves few of its bits, where it would change as many shingles as they are long. Distinct texts
whose fingerprints differ in ``radius`` bits or fewer are candidates; two texts are linked where the
Jaccard similarity of their shingle sets is high enough, and classes are what links join.

Candidates that hang together make a region. Long texts of one language have fingerprints that are
close by chance, and with their number they run together to regions that hold much of the corpus.
So a region of more than ``BLOCK`` texts is parted by shingles first: similar sets share one of their
rarest shingles (a prefix filter), and only candidates that share one stay together.

A region is dealt to blocks of at most about ``BLOCK`` texts, each of which settles all its pairs in
one task, on sorted numbers of shingles. Of a larger region one text per class and block goes on to
the next round, where classes of several blocks meet. Where a region then still has several classes,
the pairs that lead from class to class are settled as well, block against block, those within the
largest class left out. So every candidate pair that can be similar enough is either verified or lies
within a class, no pair is written down, and a text that many others resemble is compared block by
block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm.common import one_of_each, stage
from tripgauge.llm.components import components
from tripgauge.llm.simhash import cell_links, near_links

SHINGLE = 5
RADIUS = 6
SIMILARITY = 0.8
# Texts of a region that one task settles.
BLOCK = 512
# Texts of large regions, about, that tell common shingles, and in how many of them one is common.
SAMPLE = 4096
COMMON = 4
# Rows that one task hands over at once.
ROWS = 1 << 17


def words_of(text: str | None) -> list[bytes]:
    """In lower case; on bytes, these lower and split by ASCII letters and spaces only."""
    return (text or "").encode().lower().split()


def shingle_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """The 64-bit numbers of the distinct shingles of ``n`` words, sorted; of fewer words all
    are one, of none there is none."""
    from xxhash import xxh64_intdigest

    words = words_of(text)
    if len(words) <= n:
        found = [b" ".join(words)] if words else []
    else:
        found = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    return np.unique(np.fromiter((xxh64_intdigest(s, 42) for s in found), np.uint64, len(found)))


def word_print(words: list[bytes]) -> int:
    """The fingerprint as an unsigned integer, 0 without words."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    counts = Counter(words)
    hashes = np.fromiter((xxh64_intdigest(w, 42) for w in counts), "<u8", len(counts))
    weights = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)))
    ones = np.zeros(64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += weights[i:i + (1 << 16)] @ bits
    return int(np.packbits(2 * ones > weights.sum(), bitorder="little").view("<u8")[0])


def text_marks(texts: pd.Series) -> pd.DataFrame:
    """``fp, node`` of each text: its fingerprint and the digest of its words. The words of one text
    at a time are held: those of a whole batch take about nine times the room of its texts."""
    from hashlib import sha256

    fp, nodes = np.zeros(len(texts), np.uint64), []
    for i, text in enumerate(texts):
        words = words_of(text)
        fp[i] = word_print(words)
        nodes.append(sha256(b" ".join(words)).hexdigest())
    return pd.DataFrame({"fp": fp.view(np.int64), "node": nodes})


def rarest(shingles: np.ndarray, similarity: float, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """So many of a text's ``shingles``, sorted as ``shingle_set`` has them, that any set of that
    similarity shares one of those it gives itself: all but ``similarity`` of them and one more, the
    first in one order of all shingles. Any order would do; here those in ``common``, sorted, come
    last, by their ``counts``."""
    n = len(shingles) - math.ceil(similarity * len(shingles) - 1e-6) + 1
    if not len(common) or not len(shingles):
        return shingles[:n]
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    known = common[at] == shingles
    last = shingles[known][np.argsort(counts[at[known]], kind="stable")]
    return np.concatenate([shingles[~known], last])[:n]


class Cell:
    """Texts of one task: fingerprints, shingle sets, and ``root``, a number of the class of each."""

    def __init__(self, fp: np.ndarray, sets: list[np.ndarray], root: np.ndarray, radius: int, similarity: float):
        self.fp, self.root, self.radius, self.similarity = fp, root, radius, similarity
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.ends = np.cumsum(self.sizes)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        values, self.ids = np.unique(flat, return_inverse=True)
        self.held = np.zeros(len(values), bool)

    def settle(self, one: int, others: np.ndarray) -> list[int]:
        """Link ``one`` to those of ``others`` it is close enough to and not yet in a class with;
        the classes become one. The others that made a link."""
        apart = np.bitwise_count(self.fp[others] ^ self.fp[one])
        small, large = np.minimum(self.sizes[others], self.sizes[one]), np.maximum(self.sizes[others], self.sizes[one])
        # No pair of sizes further apart can be similar enough.
        ok = (apart <= self.radius) & (self.root[others] != self.root[one]) & (small >= self.similarity * large) & (small > 0)
        near = others[ok][np.argsort(apart[ok], kind="stable")]
        links = []
        # The nearest of each class first: a link to it answers for all of them.
        first = np.sort(np.unique(self.root[near], return_index=True)[1])
        for tried in (near[first], np.delete(near, first)):
            tried = tried[self.root[tried] != self.root[one]]
            for other in tried[self._similar(one, tried)].tolist():
                if self.root[other] != self.root[one]:
                    self.root[self.root == self.root[other]] = self.root[one]
                    links.append(other)
        return links

    def _similar(self, one: int, others: np.ndarray) -> np.ndarray:
        if not len(others):
            return np.zeros(0, bool)
        mine = self.ids[self.ends[one] - self.sizes[one]:self.ends[one]]
        self.held[mine] = True
        spans = [self.ids[self.ends[o] - self.sizes[o]:self.ends[o]] for o in others.tolist()]
        starts = np.cumsum([0, *map(len, spans[:-1])])
        both = np.add.reduceat(self.held[np.concatenate(spans)].astype(np.int64), starts)
        self.held[mine] = False
        return both >= self.similarity * (len(mine) + self.sizes[others] - both)


def near_rows(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, own, group`` of the rows of ``docs``: a digest of the text as it was, and the
    class, whose name is a digest of one of its texts. Texts of the same words in lower case are one.
    Null and empty texts, and those of spaces only, are one class that nothing else is in. Repeated rows and rows without an id
    are rows like any other, and no rows give no rows."""
    kind = T.StructType([T.StructField("fp", T.LongType()), T.StructField("node", T.StringType())])

    @F.pandas_udf(kind)
    def marked(texts: pd.Series) -> pd.DataFrame:
        return text_marks(texts)

    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = F.sha2(raw.cast("binary"), 256).alias("own")
    prints = stage(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), own, marked(raw).alias("m")).select("doc_id", "own", "m.*"),
        "near-prints",
    )
    nodes = stage(prints.groupBy("node").agg(F.min("fp").alias("fp"), F.min("own").alias("own")), "near-nodes")
    regions = components(near_links(stage(nodes.select("fp").distinct(), "near-fps"), radius))
    placed = nodes.join(regions.withColumnRenamed("node", "fp"), "fp", "left").select(
        "node", "fp", "own", F.coalesce("root", "fp").alias("region")
    )
    several = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stage(placed.join(several, "region"), "near-members")
    # A node's digest is that of one text: grouped by it too, whole texts move by digest once.
    texts = stage(
        docs.select(own, raw.alias("content")).join(members, "own").groupBy("own", "region", "n", "node", "fp")
        .agg(F.first("content").alias("content"))
        .select("region", "n", "node", "fp", "content"),
        "near-texts",
    )
    links = _links_of(_parted(texts, shingle, radius, similarity, block), shingle, radius, similarity, block)
    classes = components(links)
    return prints.join(classes, "node", "left").select("doc_id", "own", F.coalesce("root", "node").alias("group"))


def _parted(texts: DataFrame, shingle: int, radius: int, similarity: float, block: int) -> DataFrame:
    """``texts`` with regions of more than ``block`` parted where nothing links their texts: what is
    left of one hangs together by fingerprints within ``radius`` of texts that share one of their
    rarest shingles. Texts that are alone then are left out."""
    large = texts.filter(F.col("n") > block)
    count = large.count()
    if not count:
        return texts

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["content"]:
                yield pd.DataFrame({"cell": shingle_set(text, shingle).view(np.int64)})

    # A sample of bounded size. It decides only the order, and with it how many meet for nothing.
    sampled = large.filter(F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(max(1, count // SAMPLE))) == 0).select("content")
    seen = sampled.mapInPandas(shingles, "cell long").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    known = seen.filter(F.col("n") >= COMMON).toPandas()
    common, counts = known["cell"].to_numpy(np.int64).view(np.uint64), known["n"].to_numpy(np.int64)
    order = np.argsort(common)
    common, counts = common[order], counts[order]

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, held = [], 0
            for fp, name, text in zip(batch["fp"].tolist(), batch["name"].tolist(), batch["content"], strict=True):
                cell = rarest(shingle_set(text, shingle), similarity, common, counts).view(np.int64)
                found.append(pd.DataFrame({"cell": cell, "fp": fp, "name": name}))
                held += len(cell)
                if held >= ROWS:
                    yield pd.concat(found)
                    found, held = [], 0
            if found:
                yield pd.concat(found)

    named = large.withColumn("name", F.xxhash64("node"))
    met = named.select("fp", "name", "content").mapInPandas(cells, "cell long, fp long, name long")
    parts = stage(components(cell_links(met.repartition("cell").sortWithinPartitions("cell", "fp", "name"), radius)), "near-parts")
    sizes = parts.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    members = parts.join(sizes, "root").select(F.col("node").alias("name"), F.col("root").alias("region"), "n")
    parted = named.drop("region", "n").join(members, "name").select(*texts.columns)
    return texts.filter(F.col("n") <= block).unionByName(stage(parted, "near-parted"))


def _dealt(texts: DataFrame, block: int, salt: int) -> DataFrame:
    """``texts`` of regions of ``n`` with the number of blocks of their region and their own ``block``."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    return texts.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(salt)), F.col("blocks")).cast("int")
    )


def _counted(texts: DataFrame) -> DataFrame:
    """``texts`` with ``n``, how many there are of their region."""
    return texts.drop("n").join(texts.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "region")


def _links_of(texts: DataFrame, shingle: int, radius: int, similarity: float, block: int) -> DataFrame:
    """Links ``a, b`` that join the texts of each class of ``region, n, node, fp, content``. Texts
    move rather than their shingles, which take more room and don't compress."""

    def cell_of(rows: pd.DataFrame, root: np.ndarray) -> Cell:
        fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
        return Cell(fp, [shingle_set(t, shingle) for t in rows["content"]], root, radius, similarity)

    def within(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        cell = cell_of(rows, np.arange(len(rows)))
        for i in range(1, len(rows)):
            cell.settle(i, np.arange(i))
        nodes = rows["node"].to_numpy()
        _, first, of = np.unique(cell.root, return_index=True, return_inverse=True)
        return pd.DataFrame({"region": rows["region"], "node": nodes, "head": nodes[first[of]], "blocks": rows["blocks"]})

    kind = "region long, node string, head string, blocks int"
    active, left, found, salt = texts, None, None, 0
    while True:
        judged = stage(_dealt(active, block, salt).groupBy("region", "block").applyInPandas(within, kind), "near-heads")
        links = judged.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
        found = links if found is None else found.unionByName(links)
        heads = judged.filter("blocks > 1 AND node = head").select("node")
        now = heads.count()
        # Rounds go on while they at least halve what is open.
        if not now or left is not None and 2 * now > left:
            break
        active, left, salt = _counted(texts.filter(F.col("n") > block).join(heads, "node", "left_semi")), now, salt + 1
    large = texts.filter(F.col("n") > block)
    if large.head() is None:
        return found
    classes = components(found)
    placed = large.join(classes, "node", "left").withColumn("class", F.coalesce("root", "node"))
    sizes = placed.groupBy("region", "class").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("region").agg(
        F.max(F.struct("size", "class")).getField("class").alias("largest"), F.count(F.lit(1)).alias("classes")
    ).filter("classes > 1")
    open_ = stage(placed.join(largest, "region").select("region", "n", "node", "fp", "content", "class", "largest"), "near-open")
    if open_.head() is None:
        return found

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "node"], ignore_index=True)
        _, root = np.unique(rows["class"].to_numpy(str), return_inverse=True)
        cell, names = cell_of(rows, root), rows["class"].to_numpy()
        start = int((rows["side"] == 0).sum())
        others = np.arange(start, len(rows))
        pairs = [(names[i], names[j]) for i in range(start) for j in cell.settle(i, others)]
        return pd.DataFrame(pairs, columns=["a", "b"])

    dealt = _dealt(open_, block, salt + 1)
    outside = _dealt(_counted(open_.filter(F.col("class") != F.col("largest"))), block, salt + 2)
    counts = dealt.groupBy("region").agg(F.max("blocks").alias("all_blocks")).join(
        outside.groupBy("region").agg(F.max("blocks").alias("out_blocks")), "region"
    )

    def copies(texts: DataFrame, side: int, mine: str, other: str, most: str) -> DataFrame:
        """Each text once per block of the other side."""
        every: Column = F.explode(F.sequence(F.lit(0), F.col(most) - 1))
        return texts.join(counts, "region").select(
            "region", "node", "fp", "content", "class", F.lit(side).alias("side"), F.col("block").alias(mine), every.alias(other)
        )

    cells = copies(outside, 0, "i", "j", "all_blocks").unionByName(copies(dealt, 1, "j", "i", "out_blocks"))
    return found.unionByName(stage(cells.groupBy("region", "i", "j").applyInPandas(across, "a string, b string"), "near-across"))


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each class of near copies, all columns as they were: of the
    smallest ``doc_id``, null last."""
    own = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256)
    return one_of_each(docs, near_rows(docs.select(doc_id, text), text, doc_id, **options), F.col(f"`{doc_id}`"), own)
