"""Byte-pair encoding by per-prefix dynamic programming, and decoding.

For every prefix of a word exactly one token can be the last one of the prefix's encoding.
An Aho-Corasick automaton over the vocabulary (the suffix links of which list, for each end
position, the tokens that end there) proposes candidates, longest first. A candidate is the
last token if the prefix before it is empty and the token encodes to itself, or if the pair
(last token of the prefix before it, candidate) is compatible: the merges of the two texts
put together give these two tokens. The table of last tokens is followed back from the end
to emit the ids, without applying merges to the word. Pair tests are remembered.

The merge rules, normalisation and word pattern come from the tokenizer file (a path); ids
are those the tokenizers library gives. A word ends at white space, so encodings are kept
per white-space word in a bounded table per Python worker; texts of any length are joined
from them. Encoding is a map without a shuffle.

Cases: a NULL text is the empty text and has no ids. The two added tokens are recognised in
a text as the library does. Decoding joins token strings by a space, as the library does for
a file without a decoder. Repeated rows get the same answer, an empty table none. Other
columns are not read.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import bounded_batches

#: Words, pieces and pair tests remembered per worker; beyond, a table starts anew. Longest word that is remembered.
REMEMBERED, REMEMBERED_PAIRS, REMEMBERED_LENGTH = 300_000, 500_000, 64
#: Characters that only Python counts as white space.
ODD_SPACE = re.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> dict[int, str]:
    """The usual printable letter of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Spec:
    """What a tokenizer file says about words: added tokens, pieces, vocabulary, merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.model = spec["model"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern).findall
        # The same pattern where all letters and digits are ASCII and nothing is white space.
        self.ascii_pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split
        vocab = self.model["vocab"]
        self.strings = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}


class PrefixEncoder:
    """Encodes a piece of a word by dynamic programming over its prefixes."""

    def __init__(self, model: dict):
        end, vocab = model["end_of_word_suffix"], model["vocab"]
        # A symbol is one character: the byte, or 256 and the byte if it ends its piece.
        byte_of = {letter: b for b, letter in byte_letters().items()}
        self.symbols: list[str] = [""] * (max(vocab.values()) + 1)
        self.ids: dict[str, int] = {}
        for token, i in vocab.items():
            last = token.endswith(end) and len(token) > len(end)
            letters = [byte_of[x] for x in (token.removesuffix(end) if last else token)]
            text = "".join(map(chr, letters[:-1])) + chr(letters[-1] + 256 * last)
            self.symbols[i] = text
            self.ids[text] = i
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            automaton.add_word(text, (i, len(text)))
        automaton.make_automaton()
        self.matches = automaton.iter
        self.alone: dict[int, bool] = {}
        self.compatible: dict[int, bool] = {}

    def merged(self, text: str) -> list[int]:
        """The merge rules applied to a short text; defines which tokens may stand side by side."""
        parts = [self.ids[x] for x in text]
        while len(parts) > 1:
            known = [(self.merges.get((a, b)) or (1 << 60, -1), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            (rank, whole), k = min(known)
            if whole < 0:
                break
            parts[k : k + 2] = [whole]
        return parts

    def __call__(self, piece: str) -> list[int]:
        """Ids of one piece of the word pattern."""
        raw = piece.encode()
        text = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
        last = [-1] * (len(text) + 1)
        alone, compatible = self.alone, self.compatible
        for end, (token, length) in self.matches(text):
            if last[end + 1] >= 0:
                continue
            start = end + 1 - length
            if start == 0:
                fits = alone.get(token)
                if fits is None:
                    fits = alone[token] = self.merged(self.symbols[token]) == [token]
            else:
                before = last[start]
                if before < 0:
                    continue
                pair = before << 20 | token
                fits = compatible.get(pair)
                if fits is None:
                    if len(compatible) >= REMEMBERED_PAIRS:
                        compatible.clear()
                    both = self.symbols[before] + self.symbols[token]
                    fits = compatible[pair] = self.merged(both) == [before, token]
            if fits:
                last[end + 1] = token
        found, at = [], len(text)
        while at:
            found.append(last[at])
            at -= len(self.symbols[last[at]])
        return found[::-1]


class WordTable(dict):
    """White-space words and their ids as little-endian unsigned 32-bit integers; bounded.

    A word that is not held is encoded when it is asked for, piece by piece. Pieces are held
    too, since words differ more by case and punctuation than by their pieces. A full table
    becomes the elder one, from which words that still occur are taken over.
    """

    def __init__(self, spec: Spec, encode: Callable[[str], list[int]], remembered: int = REMEMBERED):
        super().__init__()
        self.spec, self.encode, self.remembered = spec, encode, remembered
        self.elder: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        ids = array("I", self.encode(piece))
        if sys.byteorder != "little":
            ids.byteswap()
        raw = ids.tobytes()
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self.known) >= self.remembered:
                self.known.clear()
            self.known[piece] = raw
        return raw

    def part(self, part: str) -> bytes:
        # Letters are lowered one by one: no rule for a sigma that ends a word.
        ascii_only = part.isascii()
        low = part.lower() if ascii_only else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
        if low.isalpha():
            return self.known.get(low) or self.piece(low)
        pieces = self.spec.ascii_pieces(low) if ascii_only else self.spec.pieces(low)
        return b"".join([self.known.get(piece) or self.piece(piece) for piece in pieces])

    def encoded(self, word: str) -> bytes:
        if "<|" not in word:
            return self.part(word)
        added = self.spec.added
        return b"".join(
            [added[x].to_bytes(4, "little") if x in added else self.part(x) for x in self.spec.split_added(word)]
        )

    def __missing__(self, word: str) -> bytes:
        ids = self.elder.get(word)
        if ids is None:
            ids = self.encoded(word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= self.remembered:
                self.elder = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of whole texts."""
        for text in texts:
            words = SPACE.split(text) if ODD_SPACE.search(text) else text.split()
            yield b"".join(map(self.__getitem__, words))


@cache
def prefix_encoder(path: str) -> WordTable:
    """One table per Python worker and tokenizer file."""
    spec = Spec(path)
    return WordTable(spec, PrefixEncoder(spec.model))


def decode(ids: bytes, strings: dict[int, str]) -> str:
    """Token strings joined by a space."""
    return " ".join(map(strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def per_text(make: Callable[[list[str]], list[pa.Array]]):
    """A map over batches whose last column is the text: the other columns, then what `make` gives."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make([t or "" for t in batch.columns[-1].to_pylist()])
            columns = [*batch.columns[:-1], *made]
            yield pa.record_batch(columns, names=[*batch.schema.names[:-1], *[f"made{i}" for i in range(len(made))]])

    return apply


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return bounded_batches(docs).select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: key and ids (array of long)."""

    def make(texts: list[str]) -> list[pa.Array]:
        found = [np.frombuffer(ids, "<u4").astype(np.int64) for ids in prefix_encoder(path).texts(texts)]
        return [pa.array(found, pa.list_(pa.int64()))]

    rows = keyed_texts(docs, id_col, text_col)
    schema = T.StructType([rows.schema[0]]).add("ids", T.ArrayType(T.LongType()))
    return rows.mapInArrow(per_text(make), schema)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: key and decoded text. NULL ids decode to the empty text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = prefix_encoder(path).spec.strings
        for batch in batches:
            texts = [decode(np.array(ids or [], "<u4").tobytes(), strings) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "decoded"])

    rows = encoded.select(id_col, ids_col)
    return rows.mapInArrow(apply, T.StructType([rows.schema[0]]).add("decoded", "string"))


def round_trip(
    docs: DataFrame, path: str, digest: Callable[[bytes], str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: key, n_tokens and the digests of its ids and of the text decoded from them."""

    def make(texts: list[str]) -> list[pa.Array]:
        encoder = prefix_encoder(path)
        counts, of_ids, of_text = [], [], []
        for ids in encoder.texts(texts):
            counts.append(len(ids) // 4)
            of_ids.append(digest(ids))
            of_text.append(digest(decode(ids, encoder.spec.strings).encode()))
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]

    rows = keyed_texts(docs, id_col, text_col)
    schema = T.StructType([rows.schema[0]])
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return rows.mapInArrow(per_text(make), schema)
