"""Cross-tokenizer alignment against a plain walk along the tokens of both vocabularies."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from millrace.llm.alignment import align_documents, aligner, divide, link_statistics
from millrace.llm.bpe import codec
from millrace.llm.queries import PIECES, VOCABULARY, op13_alignment
from tests.llm.conftest import DATA


@pytest.fixture(scope="module")
def plain():
    """For a text its ids under both vocabularies, the groups, and the linked ids."""
    first, second = Tokenizer.from_file(VOCABULARY), SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    bytes_a = codec(VOCABULARY).bytes_of
    names = [second.id_to_piece(k) for k in range(32000)]
    bytes_b = [bytes([int(n[3:5], 16)]) if second.is_byte(k) else n.replace("▁", " ").encode() for k, n in enumerate(names)]

    def spans(ids, table):
        ends = np.cumsum([0, *[len(table[k]) for k in ids]]).tolist()
        return [*zip(ids, ends, ends[1:])]

    def align(text):
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        raw = f" {text}".encode() if text else b""
        if any(b"".join(t[k] for k in ids) != raw for ids, t in ((a, bytes_a), (b, bytes_b))):
            return [], [], [], []
        a_spans, b_spans = spans(a, bytes_a), spans(b, bytes_b)
        links, near = [], 0
        for x, s, e in a_spans:
            while b_spans[near][2] <= s:
                near += 1
            links += [(x, y) for y, u, v in b_spans[near : near + e - s + 1] if s < v and u < e]
        groups = []
        both = {e for _, _, e in a_spans} & {e for _, _, e in b_spans}
        left = [iter(a_spans), iter(b_spans)]
        for end in sorted(both):
            parts = []
            for own in left:
                ids = []
                for k, _, v in own:
                    ids.append(str(k))
                    if v == end:
                        break
                parts.append(",".join(ids))
            groups.append("|".join(parts))
        return a, b, groups, links

    return align


@given(st.lists(st.text(alphabet="ab ▁é漢\U0001f600=.\n the rin", max_size=50) | st.none() | st.just("<|endoftext|><s>"), max_size=6))
@settings(max_examples=100, deadline=None)
def test_groups_and_links(plain, texts):
    own = aligner(VOCABULARY, PIECES)
    found = own.align(texts)
    for k, (text, written) in enumerate(zip(texts, own.written(found))):
        a, b, groups, links = plain(text)
        assert found.a.ids[found.a.bounds[k] : found.a.bounds[k + 1]].tolist() == a
        assert found.b.ids[found.b.bounds[k] : found.b.bounds[k + 1]].tolist() == b
        assert written == ";".join(groups)
        pairs = found.pairs[found.pair_bounds[k] : found.pair_bounds[k + 1]].tolist()
        assert sorted(divmod(p, 1 << 24) for p in pairs) == sorted(links)


@given(st.lists(st.integers(1, 60), min_size=1), st.lists(st.integers(1, 60), min_size=1), st.integers(1, 80))
@settings(max_examples=200, deadline=None)
def test_divide_cuts_at_all_common_ends(x, y, more):
    end = max(*x, *y) + more
    a, b = (np.array(sorted({*ends, end})) for ends in (x, y))
    starts = divide(a, b, np.array([0]), np.array([len(a)]))
    common = np.flatnonzero(np.isin(a, b))
    assert starts.tolist() == [0, *(common[:-1] + 1).tolist()]


def test_tokenizers_agree_on_words():
    """The faster encoder splits words as the tokenizer file asks for."""
    some = random.Random(4)
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    signs = [*"ab1 \t\n'.,!é̀漢　\xa0\x85\U0001f600", "'s", "'LL", "<|endoftext|>"]
    signs += [chr(c) for c in range(0x80, 0x30000, 97) if not 0xD800 <= c < 0xE000]
    texts = ["".join(some.choices(signs, k=some.randint(0, 40))) for _ in range(3000)]
    ids, bounds = aligner(VOCABULARY, PIECES).first.encode(texts)
    for k, found in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == found.ids


def expected(plain, texts):
    found = [plain(t) for t in texts]
    counts = Counter(link for *_, links in found for link in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for a, b, groups, links in found:
        best = sum(counts[link] == most[link[1]] for link in links)
        digest = sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(groups), len(links), best, sum(counts[link] for link in links), digest))
    return out


def test_odd_rows(spark, odd, none, plain):
    short = odd.where("text IS NULL OR length(text) < 1000")
    aligned = align_documents(short, VOCABULARY, PIECES).withColumn("digest", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(""))
    found = link_statistics(aligned).select("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "digest").collect()
    assert sorted(map(tuple, found)) == sorted(expected(plain, [r["text"] for r in short.collect()]))
    whole = link_statistics(align_documents(odd, VOCABULARY, PIECES))
    assert whole.count() == odd.count()
    (long,) = whole.where("id = 6").select("n_groups", "groups").collect()
    assert len(long["groups"].split(";")) == long["n_groups"] > 10_000
    assert link_statistics(align_documents(none, VOCABULARY, PIECES)).count() == 0


def test_the_query_on_the_whole_table(spark, texts, plain, monkeypatch):
    # So that there is more than one batch.
    monkeypatch.setattr("millrace.llm.alignment.BATCH_BYTES", 100_000)
    found = {r["doc_id"]: tuple(r[1:]) for r in op13_alignment(spark, str(DATA)).collect()}
    assert found.keys() == texts.keys()
    keys = [*texts]
    assert [found[k] for k in keys] == expected(plain, [texts[k] for k in keys])
