import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from ratecraft.llm.packing import CAPACITY, Packer, WordIds, cut, pack

FILE = path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, length string, offset string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text("aAéÉßŁİǅſµ'’!_·ª²٣ \t\n\x1c\x85 　́<|>startofex123", max_size=60))
def test_word_ids_are_those_of_the_tokenizer(text):
    known = _known()
    want = np.array(known.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
    assert known.of(text) == want.tobytes()
    assert known.of(text) == want.tobytes()  # and again, from memory


def test_plain_words_ask_the_model_alone(monkeypatch):
    known = WordIds(FILE)
    letters = [chr(c) for c in (*range(33, 127), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
    words = [a + b + end for a in letters for b in letters for end in ("", "é") if a + b != "<|"]  # that one may begin a special token
    want = [known.encode(word) for word in words]
    monkeypatch.setattr(known, "encode", None)
    assert [known.of(word) for word in words] == want


_cache = []


def _known():
    if not _cache:
        _cache.append(WordIds(FILE))
    return _cache[0]


def test_special_tokens_in_texts(tokenizer):
    text = "say <|endoftext|> and <|startoftext|>"
    assert _known().of(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@given(st.integers(1, 40_000))
def test_cuts_add_up_and_fill_their_class(n):
    parts = cut(n)
    assert sum(parts) == n and min(parts) > 0
    assert all(CAPACITY % p == 0 or p < 128 for p in parts)


@settings(deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60))
def test_packer_places_every_id_once_without_gaps(lengths):
    packer = Packer(0)
    docs = [np.arange(n, dtype="<u4") for n in lengths]
    for i, ids in enumerate(docs):
        packer.add(i, ids.tobytes())
    packer.finish()
    check(packer.rows, docs)
    used = {}
    for _, _, n, _, _, seq, _ in packer.rows:
        used[seq] = used.get(seq, 0) + n
    padding = sum(CAPACITY - u for u in used.values() if u & (u - 1))
    assert padding <= sum(lengths) / 32


def check(rows, docs):
    at, used = {}, {}
    for doc, start, n, crc, total, seq, offset in sorted(rows, key=lambda r: (r[0], r[1])):
        assert start == at.get(doc, 0) and total == len(docs[doc])
        assert crc == zlib.crc32(docs[doc][start:start + n].tobytes())
        at[doc] = start + n
    for doc, start, n, crc, total, seq, offset in sorted(rows, key=lambda r: (r[5], r[6])):
        assert offset == used.get(seq, 0)
        used[seq] = offset + n
    assert at == {i: len(d) for i, d in enumerate(docs)} and max(used.values(), default=0) <= CAPACITY


def test_pack_over_partitions(spark, tokenizer):
    texts = [None, "", " ", "a", "word " * 9000, "same", "same", "<|endoftext|>"] + ["some words " * i for i in range(60)]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    found = pack(spark.createDataFrame(rows, SCHEMA).repartition(3), FILE).collect()
    docs = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4") for t in texts]
    check([tuple(r) for r in found], docs)


def test_pack_repeats_null_ids_and_empty_table(spark):
    rows = [(None, "a", "", "")] * 2 + [(7, "b c", "", "")] * 3
    found = pack(spark.createDataFrame(rows, SCHEMA), FILE).collect()
    assert sum(r.length for r in found if r.doc_id is None) == 4 and sum(r.length for r in found if r.doc_id == 7) == 9
    assert pack(spark.createDataFrame([], SCHEMA), FILE).collect() == []
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([], SCHEMA), FILE, capacity=1000)
