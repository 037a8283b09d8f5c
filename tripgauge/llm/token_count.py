"""Token counts by whole tokens.

In a BPE vocabulary of pieces that mark a space, where no piece holds a space mark after another
character, no merge can join a word to the spaces that follow it. Every run of spaces with the
word after it is then a pre-token of its own. What vocabulary strings encode alone as one token is
worked out when the vocabulary is loaded, by encoding each: a pre-token that is one of those counts 1
by a look in a table. Only the rest is merged, and a worker remembers words it has merged.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.bpe import _vocabulary

# Merged pre-tokens remembered at once, and the longest of them; beyond, the memory starts anew.
MEMORY = 200_000
LONGEST = 64
MARK = "▁"


class WholeTokens(dict):
    """Token counts of pre-tokens, written without their first space. ``path`` is a
    ``sentencepiece`` BPE model that changes no characters but writes spaces as marks and puts
    one ahead of the text; others are refused."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        m = self.model
        probe = " ﬁ  Ａ\n x "
        if m.normalize(probe) != (MARK + probe).replace(" ", MARK):
            raise ValueError(f"{path} changes more than spaces")
        skipped = (m.is_control, m.is_unknown, m.is_byte, m.is_unused)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not any(skip(i) for skip in skipped)]
        # Words are certain pre-tokens only if no piece leads from one over the space to the next.
        self.cuts = not any(MARK in p.lstrip(MARK) for p in pieces)
        strings = [p[1:].replace(MARK, " ") for p in pieces if p[0] == MARK and len(p) > 1]
        alone = m.encode(strings, num_threads=1)
        self.whole = {s: 1 for s, ids in zip(strings, alone, strict=True) if len(ids) == 1}
        # A single mark: the library can't be given one without a second.
        by_bytes = any(m.is_byte(i) for i in range(m.get_piece_size()))
        self.whole[""] = 3 if MARK not in pieces and by_bytes else 1
        super().__init__(self.whole)

    def __missing__(self, word: str) -> int:
        n = len(self.model.encode(word))
        if len(word) <= LONGEST:
            if len(self) >= MEMORY + len(self.whole):
                self.clear()
                self.update(self.whole)
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.cuts:
            return len(self.model.encode(text))
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = [part[1:] for part in re.findall(" +[^ ]*", " " + text)]
        else:
            words = text.split(" ")
        return sum(map(self.__getitem__, words))


@lru_cache
def counter(path: str) -> WholeTokens:
    return WholeTokens(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of the whole ``text`` as ``n_tokens``, a column of that
    name replaced; null and empty texts have 0. ``path`` is a file, or the name of an installed
    public vocabulary. Repeated rows are counted each, and no rows give no rows."""

    @F.pandas_udf("long")
    def counts(texts: pd.Series) -> pd.Series:
        count = counter(_vocabulary(path)).count
        return pd.Series(np.fromiter(map(count, texts), np.int64, len(texts)))

    return docs.withColumn(n_tokens, counts(F.col(f"`{text}`")))
