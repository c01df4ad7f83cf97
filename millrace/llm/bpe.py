"""Byte-pair encoding by forced boundaries, and decoding.

Two neighbouring bytes that stand together inside no token of the vocabulary can never be merged,
so a text may be cut between them. A cut is used where it is also certain not to change how the
tokenizer splits a text into words; the fragments are then encoded independently of each other,
each distinct one once, and their ids are concatenated.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from millrace.llm.common import bound_batches, frugal

if TYPE_CHECKING:
    import tiktoken
    from tokenizers import Tokenizer

# Fragments up to this length are remembered, and so many of them; then memory starts afresh.
MEMORY_BYTES = 64
MEMORY_ENTRIES = 120_000
# Longer fragments are encoded one by one, by the tokenizers library itself.
LONG_BYTES = 10_000
# White space outside ASCII: such a text is cut at fewer places.
WIDE_SPACE = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Fixed value: how byte-level tokenizers split a text into words.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_symbol() -> dict[str, int]:
    """The symbol that byte-level tokenizers write for each byte: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {chr(b): b for b in plain}
    others = [b for b in range(256) if chr(b) not in symbols]
    return symbols | {chr(256 + i): b for i, b in enumerate(others)}


def _kinds() -> np.ndarray:
    """0 white space, 1 letter, 2 digit, 3 other, 4 apostrophe, 5 control or not ASCII."""
    kinds = np.full(256, 5, np.int8)
    kinds[0x21:0x7F] = 3
    for b in range(0x21, 0x7F):
        kinds[b] = 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3
    kinds[[0x20, *range(9, 14)]] = 0
    kinds[ord("'")] = 4
    return kinds


# The library remembers the words that a model has met, and never frees them, not even with the model:
# a worker must make one model and ask it all it asks once, or it grows with each task it is given.
@lru_cache(maxsize=2)
def _tokenizer(path: str, digest: bytes) -> Tokenizer:
    """The tokenizer of a file with that content."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=8)
def _whole_tokens(path: str, digest: bytes, special: frozenset[str]) -> bool:
    """Whether the bytes of every token but ``special`` become that token."""
    model = _tokenizer(path, digest)
    plain = model.get_vocab(with_added_tokens=False).keys() - special
    return all(len(model.model.tokenize(t)) == 1 for t in plain)


class Codec:
    """Encoder and decoder of one byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            raw_model = file.read()
        model = json.loads(raw_model)
        self.file = path, hashlib.sha256(raw_model).digest()
        added, bpe, splitter = model["added_tokens"], model["model"], model["pre_tokenizer"] or {}
        # What would make ids depend on more than the bytes on both sides of a cut.
        wrong = {
            "a model other than BPE": bpe.get("type") != "BPE",
            "a normalizer": bool(model.get("normalizer")),
            "a splitter other than the byte-level one": splitter.get("type") != "ByteLevel" or not splitter.get("use_regex", True),
            "a space before each text": bool(splitter.get("add_prefix_space")),
            "whole words before merges": bool(bpe.get("ignore_merges")),
            "dropout": bool(bpe.get("dropout")),
            "marks at words": bool(bpe.get("continuing_subword_prefix") or bpe.get("end_of_word_suffix")),
        }
        if any(wrong.values()):
            raise ValueError(f"not supported: {', '.join(what for what, so in wrong.items() if so)}")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("special tokens that take their surroundings are not supported")
        self.tokenizer = _tokenizer(*self.file)
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = "|".join(map(re.escape, longest_first))
        symbols = byte_of_symbol()
        self.bytes_of: list[bytes] = [b""] * self.tokenizer.get_vocab_size()
        inside = np.zeros((256, 256), bool)
        for token, number in self.tokenizer.get_vocab().items():
            if token in self.special:
                self.bytes_of[number] = token.encode()
                continue
            raw = bytes(symbols[c] for c in token)
            self.bytes_of[number] = raw
            inside[list(raw[:-1]), list(raw[1:])] = True
        self.length_of = np.array([len(b) for b in self.bytes_of], np.int64)
        self.tokens = pa.array(self.bytes_of, pa.binary())
        self.fast = self._fast_encoding(bpe)
        kinds = _kinds()
        first, second = kinds[:, None], kinds[None, :]
        # Words never reach from one kind of character to the next. White space is cut only before,
        # since a run of it is split by what follows, and an apostrophe may begin a contraction.
        changes = (first != second) & (first != 0) & (first != 5) & (second != 5)
        changes &= ~((first == 4) & (second != 0)) & ~((first == 3) & (second == 4))
        self.cuts = changes & ~inside
        # A character outside ASCII that is no white space, then white space.
        self.narrow_cuts = self.cuts.copy()
        self.cuts[0x80:, kinds == 0] = ~inside[0x80:, kinds == 0]
        self._forget()

    def _fast_encoding(self, bpe: dict) -> tiktoken.Encoding | None:
        """The same encoder by tiktoken, where that is certain to give the same ids.

        It merges any two neighbours that are a token together, by the least id; the library merges
        the listed pairs only, in their order. Both do the same if ids follow the merges and the
        bytes of every token become that token: then no other two parts of a token ever come to
        stand side by side, as they could not be merged when the token stands alone either.
        """
        import tiktoken

        merged = [a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in bpe["merges"])]
        numbers = [bpe["vocab"].get(m, -1) for m in merged]
        ordered = all(a < b for a, b in zip([-1, *numbers], numbers))
        complete = all(s in bpe["vocab"] for s in byte_of_symbol())
        if not (ordered and complete and _whole_tokens(*self.file, frozenset(self.special))):
            return None
        ranks = {self.bytes_of[n]: n for t, n in bpe["vocab"].items() if t not in self.special}
        return tiktoken.Encoding("own", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})

    def _forget(self) -> None:
        """Fragments known by their bytes, each the number of a place in ``bounds`` of ``known``."""
        self.memory = {text.encode(): k for k, text in enumerate(self.special)}
        self.known = np.array(list(self.special.values()), np.int32)
        self.bounds = np.arange(len(self.special) + 1)

    def _fragments(self, texts: pa.StringArray) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
        """The fragments of all texts one behind the other, the number of the first of each text (and
        their count), and the table of cuts that holds wherever these fragments meet."""
        plain = pc.fill_null(texts, "").cast(pa.large_binary())
        _, offsets, data = plain.buffers()
        bounds = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
        codes = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        # True where a fragment ends, by the place of its last byte.
        pairs = codes[:-1].astype(np.uint16) << 8 | codes[1:]
        cut = np.append(self.cuts.ravel()[pairs], True)[: len(codes)]
        wide = pc.fill_null(pc.match_substring_regex(texts, WIDE_SPACE), False).to_numpy(zero_copy_only=False)
        if wide.any():
            at = np.repeat(~wide, np.diff(bounds))
            cut[:-1] &= at[:-1] | self.narrow_cuts.ravel()[pairs]
        cut[bounds[(bounds > 0)] - 1] = True
        if self.special:
            marked = pc.fill_null(pc.match_substring_regex(texts, self.specials), False)
            for k in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist():
                low, high = bounds[k : k + 2].tolist()
                for m in re.finditer(self.specials.encode(), codes[low:high].tobytes()):
                    cut[low + m.start() : low + m.end()] = False
                    cut[low + m.end() - 1] = True
                    if m.start():
                        cut[low + m.start() - 1] = True
        ends = np.append(0, np.flatnonzero(cut) + 1)
        found = pa.Array.from_buffers(
            pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(codes)]
        )
        return found, np.searchsorted(ends, bounds), self.narrow_cuts if wide.any() else self.cuts

    def _encode_new(self, fragments: list[bytes], cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of fragments one behind the other, and how many each has. Neighbours whose bytes meet
        at a certain cut are encoded in one call."""
        size = np.array([len(f) for f in fragments])
        first = np.array([f[0] for f in fragments])
        last = np.array([f[-1] for f in fragments])
        # White space or words of great length would overflow the stack of tiktoken's search.
        long = size > LONG_BYTES
        apart = ~cuts[last[:-1], first[1:]] | long[:-1] | long[1:]
        starts = [0, *(np.flatnonzero(apart) + 1).tolist()]
        parts = []
        for i, j in zip(starts, [*starts[1:], len(fragments)]):
            text = b"".join(fragments[i:j]).decode()
            if self.fast is not None and not long[i]:
                parts.append(self.fast.encode_ordinary(text))
                continue
            # To the library, fragments may together look like a special token.
            joined = self.special and j - i > 1 and re.search(self.specials, text)
            for part in [f.decode() for f in fragments[i:j]] if joined else [text]:
                parts.append(self.tokenizer.encode(part, add_special_tokens=False).ids)
        ids = np.fromiter(chain.from_iterable(parts), np.int32, sum(map(len, parts)))
        stops = np.searchsorted(np.cumsum(self.length_of[ids]), np.cumsum(size)) + 1
        return ids, np.diff(stops, prepend=0)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and their bounds: one more than there are texts.

        Null has none. Strings of special tokens become those tokens. Each distinct fragment is
        looked up or encoded once; the places of all others are filled by its number.
        """
        if not len(texts):
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        fragments, firsts, cuts = self._fragments(texts)
        coded = fragments.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        memory = self.memory
        if len(memory) > MEMORY_ENTRIES:
            self._forget()
            memory = self.memory
        new = [f for f in distinct if f not in memory]
        short = [f for f in new if len(f) <= MEMORY_BYTES]
        new = short + [f for f in new if len(f) > MEMORY_BYTES] if len(short) < len(new) else short
        known, bounds, kept = self.known, self.bounds, len(memory) + len(short)
        if new:
            ids, counts = self._encode_new(new, cuts)
            known = np.append(known, ids)
            bounds = np.append(bounds, bounds[-1] + np.cumsum(counts))
            memory.update(zip(new, range(len(memory), len(memory) + len(new))))
        places = np.fromiter(map(memory.__getitem__, distinct), np.int64, len(distinct))
        for f in new[len(short) :]:
            del memory[f]
        self.known, self.bounds = known[: bounds[kept]], bounds[: kept + 1]
        places = places[coded.indices.to_numpy(zero_copy_only=False)]
        begins, sizes = bounds[places], np.diff(bounds)[places]
        ends = np.append(0, np.cumsum(sizes))
        ids = known[np.repeat(begins - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[firsts]

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; none for null."""
        ids, bounds = self.encode(pa.array(texts, pa.string()))
        every = ids.tolist()
        return [every[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> pa.StringArray:
        """The texts of ids that lie one behind the other, as :meth:`decode` gives them."""
        tokens = self.tokens.take(pa.array(ids))
        _, offsets, data = tokens.buffers()
        ends = np.frombuffer(offsets, np.int32)[tokens.offset : tokens.offset + len(tokens) + 1]
        texts = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends[bounds]), data])
        try:
            return texts.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([raw.decode("utf-8", "replace") for raw in texts.to_pylist()], pa.string())

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Codec(path)


def small_batches(batch: pa.RecordBatch, column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes of text: long texts come in smaller numbers."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    total = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    *,
    text_column: str = "text",
    ids_column: str = "ids",
    decoded_column: str | None = None,
) -> DataFrame:
    """``docs`` with the token ids of each whole text, and on request the text decoded from them.

    Ids equal those of the tokenizers library for the same file, without added special tokens.
    ``vocabulary`` is a path that every executor can open. No shuffle takes place, and memory is
    bounded by the longest text and ``MEMORY_ENTRIES`` fragments.

    Defined cases: null and empty texts have no ids and decode to the empty text; repeated rows each
    get their ids; all other columns pass through; an output name that ``docs`` already has is
    refused. An empty table gives an empty table.
    """
    new = [StructField(ids_column, ArrayType(IntegerType(), False))]
    if decoded_column:
        new.append(StructField(decoded_column, StringType()))
    taken = {c.lower() for c in docs.columns} & {f.name.lower() for f in new}
    if taken:
        raise ValueError(f"columns already there: {sorted(taken)}")
    schema = StructType([*docs.schema.fields, *new])

    bound_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of this task alone: a worker that goes on with other work does not keep it.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        own = Codec(vocabulary)
        for whole in batches:
            position = whole.schema.get_field_index(text_column)
            for batch in small_batches(whole, text_column, 1_000_000):
                ids, bounds = own.encode(batch.column(position))
                columns = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))]
                if decoded_column:
                    columns.append(own.decode_all(ids, bounds))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *columns], [*batch.schema.names, *[f.name for f in new]]
                )

    return docs.mapInArrow(frugal(encode), schema)


def decode_documents(
    docs: DataFrame, vocabulary: str, *, ids_column: str = "ids", text_column: str = "text"
) -> DataFrame:
    """``docs`` with the text of its ids; null ids decode to the empty text."""
    if text_column.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column already there: {text_column}")
    schema = StructType([*docs.schema.fields, StructField(text_column, StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_column)).to_pylist()
            texts = pa.array([own.decode(x or ()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, texts], [*batch.schema.names, text_column]
            )

    return docs.mapInArrow(decode, schema)
