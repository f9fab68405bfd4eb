"""Byte-level BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a piece there is exactly one token that can end the encoding of that prefix. An
automaton over the vocabulary (Aho-Corasick: a trie with suffix links) lists all tokens that end
at a position; one of them is the last token of the prefix if it begins the piece or if it is
compatible with the last token of the prefix before it. Following these back-pointers
from the end gives the ids. Two tokens are compatible if encoding their joint bytes gives back the two.

Texts are cut at special tokens and at white space into chunks whose encoding does not depend on what
stands around them; a bounded memo keeps the ids of recent chunks as bytes.
"""

from __future__ import annotations

import json
import re
from itertools import chain
from unicodedata import category

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritrail.llm.common import small_batches, text_of

#: White space as Unicode's White_Space property has it (Python's \s has U+001C to U+001F besides).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNKS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Where this is absent, chunks are what stands between single spaces and line feeds.
UNEVEN = re.compile(r"[\x00\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|[ \n][ \n]|\A[ \n]|[ \n]\Z")
#: The published splitting pattern of this tokenizer family, with its white space spelled out.
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def split(text: str) -> list[str]:
    """The pieces of a chunk.

    Libraries know different versions of Unicode. They agree on what this Python knows; a chunk with a code point that it does not know is split by the tokenizers
    library itself.
    """
    if text.isascii() or "Cn" not in map(category, text):
        return PIECES.findall(text)
    from tokenizers.pre_tokenizers import ByteLevel

    return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]


#: Entries of each memo; a full one is emptied. Longer keys are not kept.
MEMO, MEMO_KEY = 300_000, 48


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, the others from U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Tables of one tokenizer file (byte-level BPE without normalizer, its own splitting, plain special tokens)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec["pre_tokenizer"], spec["model"]
        plain = spec["normalizer"] is None and pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"] and model["type"] == "BPE"
        if not plain or any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError(f"{path}: only plain byte-level BPE files can be read")
        alphabet = byte_alphabet()
        vocab = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items() if token not in self.special}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        size = 1 + max([*self.bytes_of, *self.special.values()])
        self.rank = [-1] * size
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.pair_rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made = vocab[a + b]
            self.pair_rank[vocab[a], vocab[b]] = rank
            if self.parts[made] is None:
                self.rank[made], self.parts[made] = rank, (vocab[a], vocab[b])
        self.output = [self.bytes_of.get(i, b"") for i in range(size)]
        for content, i in self.special.items():
            self.output[i] = content.encode()
        self.automaton = ahocorasick.Automaton()
        for b, i in self.id_of.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.compatible_memo: dict[int, bool] = {}
        self.piece_memo: dict[str, bytes] = {}
        self.chunk_memo: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives these two tokens again.

        The merges that made their inner edges are undone, latest first; the boundary holds
        unless the two tokens at it at some time would have merged before the merge just undone.
        Of equal merges the left one comes first.
        """
        rank, parts, pair_rank = self.rank, self.parts, self.pair_rank
        before = len(rank) + 1
        while True:
            if pair_rank.get((left, right), before) < before:
                return False
            if rank[left] > rank[right]:
                before, left = rank[left], parts[left][1]
            elif rank[right] >= 0:
                before, right = rank[right] + 1, parts[right][0]
            else:
                return True

    def piece(self, b: bytes) -> list[int]:
        """The ids of one piece."""
        known, n = self.compatible_memo, len(b)
        last, start = [-1] * (n + 1), [0] * (n + 1)
        for end, (token, length) in self.automaton.iter(b.decode("latin-1")):
            end += 1
            if last[end] < 0:
                begin = end - length
                if begin:
                    key = last[begin] << 32 | token
                    fits = known.get(key)
                    if fits is None:
                        if len(known) >= 2 * MEMO:
                            known.clear()
                        fits = known[key] = self.compatible(last[begin], token)
                    if not fits:
                        continue
                last[end], start[end] = token, begin
        ids = []
        while n:
            ids.append(last[n])
            n = start[n]
        return ids[::-1]

    def chunk(self, text: str) -> bytes:
        """The ids of one chunk as little-endian unsigned 32-bit integers."""
        out = []
        for piece in split(text):
            ids = self.piece_memo.get(piece)
            if ids is None:
                b = piece.encode()
                ids = np.array(self.piece(b), dtype="<u4").tobytes()
                if len(piece) <= MEMO_KEY:
                    if len(self.piece_memo) >= MEMO:
                        self.piece_memo.clear()
                    self.piece_memo[piece] = ids
            out.append(ids)
        return b"".join(out)

    def _remember(self, key: str, text: str) -> bytes:
        ids = self.chunk(text)
        if len(key) <= MEMO_KEY:
            if len(self.chunk_memo) >= MEMO:
                self.chunk_memo.clear()
            self.chunk_memo[key] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        get = self.chunk_memo.get
        if UNEVEN.search(text):
            # keys begin with U+0000 if no space comes before the chunk
            out = []
            for c in CHUNKS.findall(text):
                key = c[1:] if len(c) > 1 and c[0] == " " and not c[1].isspace() and c[1] != "\0" else f"\0{c}"
                out.append(get(key) or self._remember(key, c))
            return b"".join(out)
        keys = ("\0" + text.replace("\n", " \0\n \0")).split(" ")
        found = [*map(get, keys)]
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    key = keys[i]
                    found[i] = get(key) or self._remember(key, key[1:] if key[0] == "\0" else f" {key}")
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; special tokens in it are found first."""
        if self.cut_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.cut_special.split(text)
        return b"".join(chain.from_iterable((self._plain(p), self.special[parts[i + 1]].to_bytes(4, "little") if i + 1 < len(parts) else b"") for i, p in enumerate(parts) if i % 2 == 0))

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.output.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


class FastBpe(Bpe):
    """The same ids, chunks encoded by the tiktoken library where only ids are wanted."""

    def __init__(self, path: str):
        import tiktoken

        super().__init__(path)
        self.library = tiktoken.Encoding("own", pat_str=PIECES.pattern, mergeable_ranks=self.id_of, special_tokens={})

    def chunk(self, text: str) -> bytes:
        if not text.isascii() and "Cn" in map(category, text):
            return super().chunk(text)
        return np.array(self.library.encode_ordinary(text), dtype="<u4").tobytes()


_loaded: dict[tuple[type, str], Bpe] = {}


def load(path: str, kind: type[Bpe] = Bpe) -> Bpe:
    """The tables of a file, read once in each Python worker."""
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


def encode_udf(path: str):
    @F.pandas_udf(T.BinaryType())
    def encode(texts: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([bpe.encode(t) for t in texts], dtype=object)

    return encode


def decode_udf(path: str):
    @F.pandas_udf(T.StringType())
    def decode(ids: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([bpe.decode(b) for b in ids], dtype=object)

    return decode


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (little-endian unsigned 32-bit integers in a binary) and decoded, the text made from these ids.

    Null and empty texts have no ids. Ids may be null or repeated: each row gives a row. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    encoded = docs.select(F.col(id_col), encode_udf(path)(text_of(text_col)).alias("ids"))
    return encoded.select(F.col(id_col), "ids", decode_udf(path)("ids").alias("decoded"))
