"""SentencePiece encoding by vectorised merge rounds, and decoding.

All words of a batch that are not known yet are laid one behind the other in flat numpy arrays of
symbols. A round finds the least pair rank of every word at once, merges its leftmost pairs in all
words together, and compacts the arrays; words without a pair left leave them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from millrace.llm.bpe import small_batches

SPACE = "▁"
# Words up to this length are remembered, until they and their ids take so many bytes.
MEMORY_WORD = 48
MEMORY_BYTES = 48_000_000
# A word begins at each run of spaces; pieces never reach across such a place (checked on loading).
PIECE_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NEVER = np.iinfo(np.int32).max


class Encoded(NamedTuple):
    """Ids of many texts one behind the other; text k has ``ids[bounds[k]:bounds[k + 1]]``."""

    ids: np.ndarray
    bounds: np.ndarray


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...``: ``sizes[k]`` numbers from each start."""
    total = int(sizes.sum())
    shift = starts - np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else starts
    return np.repeat(shift, sizes) + np.arange(total)


class PieceCodec:
    """Encoder and decoder of one SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        model = ModelProto()
        model.ParseFromString(SentencePieceProcessor(model_file=path).serialized_model_proto())
        self._refuse(model)
        kinds = model.SentencePiece
        self.unknown = next(k for k, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.unknown_text = model.trainer_spec.unk_surface.encode()
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.count = len(model.pieces)
        # What each id decodes to, and whether it is a byte or stands for nothing.
        self.bytes_of = [p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        self.is_byte = np.zeros(self.count, bool)
        self.is_control = np.zeros(self.count, bool)
        self.byte_id = np.zeros(256, np.int32)
        scored: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        for k, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                byte = int(p.piece[3:5], 16)
                self.byte_id[byte], self.is_byte[k], self.bytes_of[k] = k, True, bytes([byte])
            elif p.type == kinds.CONTROL:
                self.is_control[k], self.bytes_of[k] = True, b""
            elif p.type == kinds.NORMAL:
                scored[p.piece], self.id_of[p.piece] = p.score, k
        self.bytes_of[self.unknown] = self.unknown_text
        self.length_of = np.array([len(b) for b in self.bytes_of], np.int64)
        if any(b == SPACE != a for piece in scored for a, b in zip(piece, piece[1:])):
            raise ValueError("pieces with a space behind another character are not supported")
        self._index(scored)
        self.forget()

    @staticmethod
    def _refuse(model) -> None:  # noqa: ANN001
        """Only models whose result these rounds give are taken."""
        normalizer, trainer = model.normalizer_spec, model.trainer_spec
        kinds = model.SentencePiece
        others = {p.type for p in model.pieces} - {kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN}
        wrong = {
            "a model other than BPE": trainer.model_type != trainer.BPE,
            "no byte fallback": not trainer.byte_fallback,
            "space as suffix": trainer.treat_whitespace_as_suffix,
            "a normalizer": bool(normalizer.precompiled_charsmap) or normalizer.remove_extra_whitespaces,
            "spaces that are not escaped": not normalizer.escape_whitespaces,
            "a denormalizer": bool(model.denormalizer_spec.precompiled_charsmap),
            "user-defined or unused pieces": bool(others),
        }
        found = [what for what, so in wrong.items() if so]
        if found:
            raise ValueError(f"not supported: {', '.join(found)}")

    def _index(self, scored: dict[str, float]) -> None:
        """Symbols are pieces and the characters inside them; pairs of symbols get ranks."""
        letters = sorted({c for piece in scored for c in piece})
        names = [*dict.fromkeys([*letters, *scored])]
        symbol = {name: k for k, name in enumerate(names)}
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        self.letter_symbol = np.array([symbol[c] for c in letters], np.int32)
        self.unknown_symbol = len(names)
        self.base = len(names) + 1
        self.symbol_id = np.array([self.id_of.get(name, -1) for name in names] + [-1], np.int32)
        ranks = {score: k for k, score in enumerate(sorted(set(scored.values()), reverse=True))}
        keys, rank, result = [], [], []
        # Whether a merge of this rank may make a pair of the same or a better rank.
        hasty = np.zeros(len(ranks) + 1, bool)
        for piece, score in scored.items():
            own = ranks[score]
            for k in range(1, len(piece)):
                left, right = piece[:k], piece[k:]
                if left in symbol and right in symbol:
                    keys.append(symbol[left] * self.base + symbol[right])
                    rank.append(own)
                    result.append(symbol[piece])
                    for part in (left, right):
                        if len(part) > 1 and ranks[scored[part]] >= own:
                            hasty[ranks[scored[part]]] = True
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_rank = np.array(rank, np.int32)[order]
        self.pair_result = np.array(result, np.int32)[order]
        self.hasty = hasty
        near = {symbol[a] * self.base + symbol[b] for piece in scored for a, b in zip(piece, piece[1:])}
        self.near = np.array(sorted(near), np.int64)

    def forget(self) -> None:
        self.memory: dict[str, int] = {}
        self.memory_bytes = 0
        self.kept_ids: list[np.ndarray] = []
        self.kept_sizes: list[np.ndarray] = []

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the pairs that merge, or -1."""
        wanted = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.pair_keys, wanted)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == wanted, at, -1)

    def merge(self, words: list[str]) -> Encoded:
        """Ids of each word, by merge rounds over all of them together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.letters, codes)
        at[at == len(self.letters)] = 0
        known = self.letters[at] == codes
        symbols = np.where(known, self.letter_symbol[at], self.unknown_symbol).astype(np.int32)
        word = np.repeat(np.arange(len(words)), sizes)
        alive = np.ones(len(codes), bool)
        if len(codes) > 1:
            # Two characters that stand together inside no piece: what lies across is independent.
            beside = symbols[:-1].astype(np.int64) * self.base + symbols[1:]
            place = np.searchsorted(self.near, beside)
            place[place == len(self.near)] = 0
            joined = (self.near[place] == beside) & (word[1:] == word[:-1])
            part = np.concatenate(([0], np.cumsum(~joined)))
            self._rounds(symbols, part, alive)
        ids = self.symbol_id[symbols]
        plain = ids[alive]
        word = word[alive]
        if (plain >= 0).all():
            return Encoded(plain, np.searchsorted(word, np.arange(len(words) + 1)))
        # Characters that are no piece become the ids of their bytes.
        left = np.flatnonzero(alive)
        flat: list[np.ndarray] = []
        repeats = np.ones(len(plain), np.int64)
        lost = np.flatnonzero(plain < 0)
        start = 0
        for k in lost.tolist():
            raw = chr(int(codes[left[k]])).encode()
            flat += [plain[start:k], self.byte_id[list(raw)]]
            repeats[k] = len(raw)
            start = k + 1
        flat.append(plain[start:])
        word = np.repeat(word, repeats)
        return Encoded(np.concatenate(flat), np.searchsorted(word, np.arange(len(words) + 1)))

    def _rounds(self, symbols: np.ndarray, part: np.ndarray, alive: np.ndarray) -> None:
        """Merges in place: ``symbols`` of the characters that stay ``alive``.

        The library merges the best pair of a word, the leftmost of equals, one at a time. Equal
        pairs may be merged in one round where the result cannot make a pair as good or better
        (``hasty`` marks where it can); there only the leftmost is.
        """
        place = np.arange(len(symbols))
        active, owner = symbols.copy(), part

        def pairs(left: np.ndarray) -> np.ndarray:
            """Places in the table of pairs of the symbols at ``left`` and those behind them."""
            found = np.full(len(left), -1, np.int64)
            inner = np.flatnonzero(left + 1 < len(active))
            i = left[inner]
            same = owner[i] == owner[i + 1]
            i, inner = i[same], inner[same]
            found[inner] = self._look_up(active[i], active[i + 1])
            return found

        entry = pairs(np.arange(len(active)))
        while True:
            rank = np.where(entry >= 0, self.pair_rank[entry], NEVER)
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(active)))
            going = least < NEVER
            if not going.all():
                # Finished words leave the arrays.
                out = np.repeat(~going, sizes)
                symbols[place[out]] = active[out]
                stay = ~out
                active, owner, place, entry, rank = (x[stay] for x in (active, owner, place, entry, rank))
                least, sizes = least[going], sizes[going]
                if not len(active):
                    return
            own = np.repeat(np.arange(len(sizes)), sizes)
            chosen = np.flatnonzero(rank == least[own])
            owners = own[chosen]
            first = np.concatenate(([True], owners[1:] != owners[:-1]))
            # Of pairs that overlap in a run, every second one from the left.
            runs = np.concatenate(([True], chosen[1:] != chosen[:-1] + 1)) | first
            number = np.arange(len(chosen))
            offset = number - np.maximum.accumulate(np.where(runs, number, 0))
            taken = chosen[np.where(self.hasty[least[owners]], first, offset % 2 == 0)]
            active[taken] = self.pair_result[entry[taken]]
            keep = np.ones(len(active), bool)
            keep[taken + 1] = False
            alive[place[taken + 1]] = False
            new = np.cumsum(keep) - 1
            moved = new[taken]
            active, owner, place, entry = (x[keep] for x in (active, owner, place, entry))
            changed = np.concatenate((moved, moved[moved > 0] - 1))
            entry[changed] = pairs(changed)

    def encode(self, texts: Iterable[str | None]) -> Encoded:
        """Ids of each whole text; none for null and empty texts."""
        if self.memory_bytes > MEMORY_BYTES:
            self.forget()
        found: list[list[str]] = []
        for text in texts:
            if not text:
                found.append([])
                continue
            spaced = text.replace(" ", SPACE)
            found.append(PIECE_WORDS.findall(SPACE + spaced if self.prefix else spaced))
        memory = self.memory
        new = [*set().union(*found).difference(memory)]
        known = len(memory)
        # Long words come last, and are forgotten after this batch.
        long = [w for w in new if len(w) > MEMORY_WORD]
        if long:
            new = [w for w in new if len(w) <= MEMORY_WORD] + long
        short = len(new) - len(long)
        fresh = self.merge(new) if new else Encoded(np.empty(0, np.int32), np.zeros(1, np.int64))
        memory.update(zip(new[:short], range(known, known + short)))
        numbers = memory | dict(zip(long, range(known + short, known + len(new)))) if long else memory
        kept = int(fresh.bounds[short])
        self.kept_ids.append(fresh.ids[:kept])
        self.kept_sizes.append(np.diff(fresh.bounds[: short + 1]))
        flat = np.concatenate([*self.kept_ids, fresh.ids[kept:]])
        sizes = np.concatenate([*self.kept_sizes, np.diff(fresh.bounds[short:])])
        self.kept_ids, self.kept_sizes = [flat[: len(flat) - len(fresh.ids) + kept]], [sizes[: known + short]]
        self.memory_bytes += sum(map(len, new[:short])) * 4 + 110 * short + 4 * kept
        starts = np.concatenate(([0], np.cumsum(sizes)))
        counts = np.fromiter(map(len, found), np.int64, len(found))
        which = np.fromiter(map(numbers.__getitem__, chain.from_iterable(found)), np.int64, int(counts.sum()))
        own = sizes[which]
        bounds = np.concatenate(([0], np.cumsum(own)))[np.concatenate(([0], np.cumsum(counts)))]
        return Encoded(flat[spans(starts[which], own)], bounds)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: a leading space that encoding put there goes, control ids are nothing,
        and bytes that are no UTF-8 become U+FFFD each."""
        ids = np.asarray(ids if isinstance(ids, np.ndarray) else [*ids], np.int64)
        if not len(ids):
            return ""
        said = np.flatnonzero(~self.is_control[ids])
        pieces = [*map(self.bytes_of.__getitem__, ids.tolist())]
        if self.prefix and len(said):
            first = int(said[0])
            if not self.is_byte[ids[first]] and ids[first] != self.unknown and pieces[first][:1] == b" ":
                pieces[first] = pieces[first][1:]
        if not self.is_byte[ids].any():
            return b"".join(pieces).decode()
        try:
            return b"".join(pieces).decode()
        except UnicodeDecodeError:
            return self._decode_runs(pieces, self.is_byte[ids])

    @staticmethod
    def _decode_runs(pieces: list[bytes], is_byte: np.ndarray) -> str:
        edges = np.flatnonzero(np.diff(is_byte.astype(np.int8))) + 1
        out = []
        for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(pieces)]):
            run = b"".join(pieces[i:j])
            if not is_byte[i]:
                out.append(run.decode())
                continue
            k = 0
            while k < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[k : k + size].decode())
                        k += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    k += 1
        return "".join(out)


@lru_cache(maxsize=2)
def piece_codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_pieces(
    docs: DataFrame,
    model: str,
    *,
    text_column: str = "text",
    ids_column: str = "ids",
    decoded_column: str | None = None,
) -> DataFrame:
    """``docs`` with the ids of each whole text, and on request the text decoded from them.

    Ids equal those of the sentencepiece library for the same BPE model with byte fallback, without
    begin and end ids and without sampling; ``decoded_column`` holds what its ``decode`` gives.
    Models that need more (a normalizer, user-defined pieces, another kind of model) are refused.
    ``model`` is a path that every executor can open. No shuffle takes place; memory is bounded by
    the longest text and ``MEMORY_BYTES`` of words.

    Very long texts are encoded whole. A word takes at most as many rounds as it has merges, and
    equal pairs are merged in one round, so a text without any space takes some hundred rounds.

    Defined cases: null and empty texts have no ids and decode to the empty text; a character that
    is no piece becomes its bytes; U+2581 in a text counts as a space, as in the library; repeated
    rows each get their ids; all other columns pass through; an output name that ``docs`` already
    has is refused. An empty table gives an empty table.
    """
    new = [StructField(ids_column, ArrayType(IntegerType(), False))]
    if decoded_column:
        new.append(StructField(decoded_column, StringType()))
    taken = {c.lower() for c in docs.columns} & {f.name.lower() for f in new}
    if taken:
        raise ValueError(f"columns already there: {sorted(taken)}")
    schema = StructType([*docs.schema.fields, *new])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_codec(model)
        for whole in batches:
            position = whole.schema.get_field_index(text_column)
            for batch in small_batches(whole, text_column, 2_000_000):
                ids, bounds = own.encode(batch.column(position).to_pylist())
                columns = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
                if decoded_column:
                    ends = bounds.tolist()
                    texts = [own.decode(ids[i:j]) for i, j in zip(ends, ends[1:])]
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *columns], [*batch.schema.names, *[f.name for f in new]]
                )

    return docs.mapInArrow(encode, schema)


def decode_pieces(
    docs: DataFrame, model: str, *, ids_column: str = "ids", text_column: str = "text"
) -> DataFrame:
    """``docs`` with the text of its ids; null ids decode to the empty text."""
    if text_column.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column already there: {text_column}")
    schema = StructType([*docs.schema.fields, StructField(text_column, StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_codec(model)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_column)).to_pylist()
            texts = pa.array([own.decode(x or ()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, text_column])

    return docs.mapInArrow(decode, schema)
