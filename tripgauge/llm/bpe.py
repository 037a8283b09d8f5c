"""BPE encoding and decoding with forced boundaries.

Where two neighbouring bytes stand side by side inside no token of the vocabulary, no
merge can ever join them: the text is cut there for certain. Fragments between such cuts
are encoded on their own and concatenated; a worker remembers words it has met.

The vocabulary is a ``tokenizers`` JSON file of a byte-level BPE whose words end in a
suffix, which splits text into words by a pattern before merging.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Words remembered at once; beyond that the memory starts anew.
MEMORY = 200_000
# Rows held encoded or decoded at once.
AT_ONCE = 256
# The letters, numbers and spaces below U+0250.
_L, _N, _S = "a-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\\t-\\r \x85\xa0"
# Latin text in lower case, cut as the vocabulary's own pattern does.
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


class ForcedBoundaryBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        # The library reads the file and applies its normalising and splitting rules.
        self.rules = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        ranks = [tuple(p) for p in pairs]
        self.tokens = {i: t for t, i in self.ids.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in special.items()})
        self.special = special
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.table = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]
        self.byte_chars = _byte_chars()
        # Neighbours that some token holds; any other pair is a certain cut.
        self.inside = {
            t[i:i + 2]
            for token in self.ids
            for t in [token.removesuffix(self.suffix) if self.suffix else token]
            for i in range(len(t) - 1)
        }
        # Merges of a fragment within a word, and of a word's last one.
        self.inner = BPE(self.ids, ranks)
        self.final = BPE(self.ids, ranks, end_of_word_suffix=self.suffix) if self.suffix else self.inner
        self.known = _Known(self.word_ids)

    def fragments(self, word: str) -> list[str]:
        """The pieces of a word, in byte characters, between its certain cuts."""
        cuts = [i + 1 for i in range(len(word) - 1) if word[i:i + 2] not in self.inside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def word_ids(self, word: str) -> bytes:
        """Ids of one word, as little-endian 32-bit integers."""
        *pieces, last = self.fragments("".join(map(self.byte_chars.__getitem__, word.encode())))
        ids = [t.id for piece in pieces for t in self.inner.tokenize(piece)]
        ids += [t.id for t in self.final.tokenize(last)]
        return np.array(ids, "<u4").tobytes()

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        lowered = text.lower()
        # No letter that could combine or be of a later Unicode; some below the bound lower to one above.
        if text.isascii() or max(text) < "ɐ" and max(lowered) < "ɐ":
            return _LATIN_WORDS.findall(lowered)
        text = self.rules.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.rules.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; null counts as empty. Strings of special tokens become those."""
        if not text:
            return np.zeros(0, "<u4")
        parts, at, known = [], 0, self.known.__getitem__
        if "<" in text:
            for m in self.special_pattern.finditer(text):
                parts += map(known, self.words(text[at:m.start()]) if m.start() > at else ())
                parts.append(np.array([self.special[m[0]]], "<u4").tobytes())
                at = m.end()
        rest = text[at:] if at else text
        if rest:
            parts += map(known, self.words(rest))
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids) -> str:
        """The tokens with a space between, special ones included; unknown ids are left out."""
        table, n = self.table, len(self.table)
        return " ".join([t for i in np.asarray(ids).tolist() if 0 <= i < n and (t := table[i])])


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in chars)
    chars.update({b: chr(256 + i) for i, b in enumerate(rest)})
    return [chars[b] for b in range(256)]


class _Known(dict):
    """Ids by word, made when first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        ids = self.make(word)
        if len(word) <= 256:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = ids
        return ids


@lru_cache
def codec(path: str) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(path)


def _vocabulary(path: str) -> str:
    """A name without a folder is a file of the installed public vocabularies, on every executor."""
    if "/" in path:
        return path
    import public_tokenizers

    return public_tokenizers.path(path)


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded_sha256: str | None = None
) -> DataFrame:
    """``docs`` with the token ids of ``text`` as ``array<int>``; null texts get none. With
    ``decoded_sha256`` also, under that name, the digest of what the ids decode to.
    Columns of these names are replaced. A few rows at a time are held encoded."""
    added = [ids, *([decoded_sha256] if decoded_sha256 else [])]
    kept = [c for c in docs.columns if c not in added]
    schema = docs.select(*kept).schema.add(ids, T.ArrayType(T.IntegerType()))
    if decoded_sha256:
        schema = schema.add(decoded_sha256, T.StringType())

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(_vocabulary(path))
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                part = batch[at:at + AT_ONCE]
                found = part[kept].copy()
                found[ids] = [bpe.encode(t).astype(np.int32) for t in part[text]]
                if decoded_sha256:
                    found[decoded_sha256] = [hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in found[ids]]
                yield found

    return docs.mapInPandas(encode, schema)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of ``ids``; a column of that name is replaced."""
    kept = [c for c in encoded.columns if c != text]
    schema = encoded.select(*kept).schema.add(text, T.StringType())

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(_vocabulary(path))
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                part = batch[at:at + AT_ONCE]
                found = part[kept].copy()
                found[text] = [bpe.decode(() if i is None else i) for i in part[ids]]
                yield found

    return encoded.mapInPandas(decode, schema)


def token_digests(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row: encoded, and decoded
    from the ids, in one pass that keeps neither."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(_vocabulary(path))
        for batch in batches:
            rows = []
            for value in batch["text"]:
                ids = bpe.encode(value)
                decoded = bpe.decode(ids).encode()
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            found = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            found.insert(0, "doc_id", batch["doc_id"].array)
            yield found

    narrow = docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInPandas(
        digests, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
