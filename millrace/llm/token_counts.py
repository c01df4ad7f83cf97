"""Token counts of sections: a document is encoded once and its tokens are attributed by offset."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from millrace.llm.bpe import codec, small_batches

# Where a token goes that crosses from one section into another.
RULES = ("first", "last", "largest")


def _attribute(
    spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of those reach beyond it.

    ``spans`` holds the boundaries of the tokens, one more than there are tokens; the sections are
    in order and do not overlap. Both sides are sorted, so the interval join is a merge.
    """
    counts = np.zeros(len(starts), np.int64)
    crossing = np.zeros(len(starts), np.int64)
    if not len(starts) or len(spans) < 2:
        return counts, crossing
    left, right = spans[:-1], spans[1:]
    # The sections that a token meets are low .. high - 1; empty sections meet none.
    filled = np.flatnonzero(ends > starts)
    if not len(filled):
        return counts, crossing
    begin, end = starts[filled], ends[filled]
    low = np.searchsorted(end, left, side="right")
    high = np.searchsorted(begin, right, side="left")
    meets = high > low
    low, high, left, right = low[meets], high[meets], left[meets], right[meets]
    if rule == "first":
        chosen = low
    elif rule == "last":
        chosen = high - 1
    else:
        chosen = low.copy()
        for k in np.flatnonzero(high - low > 1):
            met = np.arange(low[k], high[k])
            shared = np.minimum(end[met], right[k]) - np.maximum(begin[met], left[k])
            chosen[k] = met[np.argmax(shared)]
    beyond = (left < begin[chosen]) | (right > end[chosen])
    np.add.at(counts, filled[chosen], 1)
    np.add.at(crossing, filled[chosen[beyond]], 1)
    return counts, crossing


def count_section_tokens(
    docs: DataFrame,
    vocabulary: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    sections_column: str | None = None,
    separator: str = "\n",
    rule: str = "first",
) -> DataFrame:
    """One row per section: id, ``section``, ``start``, ``end``, ``n_tokens``, ``n_crossing``.

    Each whole text is encoded once; the span of every token is joined to the sections it overlaps.
    Sections come from ``sections_column``, an array of structs ``start, end`` in code points, in
    order and apart from each other; without it each line with its separator is one. A token within
    one section counts there. One that crosses a boundary counts once, by ``rule``: ``first`` gives
    it to the first section it overlaps, ``last`` to the last, ``largest`` to the one with the most
    of it (the earlier of equals). ``n_crossing`` counts those that reach beyond their section. With
    sections that cover a text the counts add up to its tokens; tokens outside all sections count
    nowhere. Spans are compared in bytes, which agrees with code points, as sections begin and end
    between characters; a token of part of a character belongs where that character is.

    Defined cases: a null text counts as empty and has one empty section without tokens (none with
    ``sections_column`` null or empty); a text that ends in the separator has no empty line after
    it; sections beyond the end are cut at the end; other columns are ignored; repeated rows each
    give their sections.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    given = [F.col(sections_column).alias("sections")] if sections_column else []
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"), *given
    )
    schema = StructType(
        [
            StructField(id_column, rows.schema["id"].dataType),
            StructField("section", IntegerType()),
            StructField("start", LongType()),
            StructField("end", LongType()),
            StructField("n_tokens", LongType()),
            StructField("n_crossing", LongType()),
        ]
    )

    def one(text: str, sections: list[dict] | None, ids: list[int], lengths: np.ndarray):
        raw = text.encode()
        # Byte offset of each character: bytes that continue one have the form 10xxxxxx.
        plain = len(raw) == len(text)
        offsets = None
        if not plain:
            codes = np.frombuffer(raw, np.uint8)
            offsets = np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(raw))
        if sections_column:
            bounds = [(s["start"], s["end"]) for s in sections or ()]
            starts = np.clip(np.array([b[0] for b in bounds], np.int64), 0, len(text))
            ends = np.clip(np.array([b[1] for b in bounds], np.int64), 0, len(text))
        else:
            pieces = text.split(separator)
            sizes = np.array([len(p) + len(separator) for p in pieces], np.int64)
            sizes[-1] -= len(separator)
            if len(pieces) > 1 and not pieces[-1]:
                sizes = sizes[:-1]
            ends = np.cumsum(sizes)
            starts = ends - sizes
        spans = np.concatenate(([0], np.cumsum(lengths[ids])))
        places = (starts, ends) if plain else (offsets[starts], offsets[ends])
        return starts, ends, *_attribute(spans, *places, rule)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for whole in batches:
            for batch in small_batches(whole, "text"):
                texts = batch.column(1).to_pylist()
                sections = batch.column(2).to_pylist() if sections_column else [None] * len(texts)
                found = [
                    one(text, own_sections, ids, own.length_of)
                    for text, own_sections, ids in zip(texts, sections, own.encode_batch(texts))
                ]
                sizes = [len(f[0]) for f in found]
                which = np.repeat(np.arange(len(found)), sizes)
                number = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
                columns = [np.concatenate([f[k] for f in found]).astype(np.int64) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(which)), pa.array(number), *map(pa.array, columns)],
                    schema.names,
                )

    return rows.mapInArrow(count, schema)


def count_field_tokens(
    docs: DataFrame, vocabulary: str, fields: list[str], *, joiner: str = "\n", **options: str
) -> DataFrame:
    """Token counts of text fields that are joined to one text and encoded once.

    ``section`` is the number of the field; the joiner counts with the field before it. A null field
    counts as empty.
    """
    values = [F.coalesce(F.col(f), F.lit("")) for f in fields]
    lengths = [F.char_length(v) + (len(joiner) if k + 1 < len(fields) else 0) for k, v in enumerate(values)]
    ends = [sum(lengths[1 : k + 1], lengths[0]) for k in range(len(fields))]
    starts = [F.lit(0), *ends[:-1]]
    sections = F.array(
        *[F.struct(a.alias("start"), b.alias("end")) for a, b in zip(starts, ends)]
    )
    id_column = options.get("id_column", "doc_id")
    joined = docs.select(
        F.col(id_column), F.concat_ws(joiner, *values).alias("_text"), sections.alias("_sections")
    )
    return count_section_tokens(
        joined, vocabulary, text_column="_text", sections_column="_sections", **options
    )
