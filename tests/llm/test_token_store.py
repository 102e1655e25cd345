from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import ODD, SMALL, odd, table
from millrace.llm import token_store
from millrace.llm.queries import QUERIES, tokenizer_path
from millrace.llm.rans import Coder, pack_table, quantised
from millrace.llm.token_store import WordEncoder, document_digests, read_documents, write_store
from millrace.workspace import fresh_dir


def plain_ids(texts: list) -> list[list[int]]:
    """The contract: every text encoded whole, nothing switched."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_query_equals_brute_force(spark):
    docs = sorted((r[0], r[1]) for r in table("documents"))
    expected, at = [], 0
    for (doc_id, _), ids in zip(docs, plain_ids([t for _, t in docs])):
        ids = [*ids, 1]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op1_token_ids"](spark, SMALL).collect())) == expected


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abS'’.,é!?12² \t\ń—Ⅷ<|>end", max_size=40), max_size=6))
def test_words_have_the_ids_they_have_in_texts(texts):
    flat, lengths = WordEncoder.of(tokenizer_path()).batch(pa.array(texts, pa.string()))
    found = np.split(flat, np.cumsum(lengths)[:-1]) if len(texts) else []
    assert [f.tolist() for f in found] == plain_ids(texts)


def held_bytes(encoder: WordEncoder) -> int:
    """What an encoder remembers, however it does: dicts by their entries, arrays by their buffers."""
    own = [v for k, v in vars(encoder).items() if k not in ("added", "tokenizer")]
    dicts = sum(sys.getsizeof(d) + sum(sys.getsizeof(x) for kv in d.items() for x in kv) for d in own if isinstance(d, dict))
    return dicts + sum(a.nbytes for a in own if isinstance(a, (pa.Array, np.ndarray)))


def test_a_worker_remembers_words_in_few_bytes():
    encoder = WordEncoder(tokenizer_path())
    for first in range(0, 200_000, 5_000):
        texts = [" ".join(f"word{i * 7919 % 1_000_003}," for i in range(first, first + 5_000))]
        flat, _ = encoder.batch(pa.array(texts))
    assert flat.tolist() == plain_ids(texts)[0]
    assert held_bytes(encoder) <= 20 << 20


def test_words_are_forgotten_and_met_again(monkeypatch):
    monkeypatch.setattr(token_store, "REMEMBERED", 2_000)
    encoder = WordEncoder(tokenizer_path())
    texts = [" ".join(f"{'x' * (j % 90)}a{i}.. it's," for j in range(i, i + 40)) for i in range(60)]
    for text in texts + texts[::-1]:
        flat, lengths = encoder.batch(pa.array([text, "", None, "...", text], pa.string()))
        assert [f.tolist() for f in np.split(flat, np.cumsum(lengths)[:-1])] == plain_ids([text, "", "", "...", text])
        assert held_bytes(encoder) <= 4_000
    flat, lengths = encoder.batch(pa.array(texts, pa.large_string()))
    assert [f.tolist() for f in np.split(flat, np.cumsum(lengths)[:-1])] == plain_ids(texts)


@pytest.mark.parametrize("count", [0, 1, 3, 100, 2048, 2049, 70_000])
def test_blocks_round_trip_whole_and_by_mark(count):
    rng = np.random.default_rng(count)
    tokens = np.minimum(rng.zipf(1.3, count), 60_000).astype(np.uint32)
    coder = Coder(pack_table(quantised(np.bincount(tokens, minlength=60_001))))
    block = coder.encode(tokens, lanes=64, mark_steps=16)
    assert np.array_equal(coder.decode(block), tokens)
    steps = -(-count // max(1, min(64, count)))
    parts = [coder.decode(block, mark) for mark in range(-(-steps // 16))]
    assert np.array_equal(np.concatenate(parts or [tokens]), tokens)


def test_damage_is_found():
    tokens = np.arange(500, dtype=np.uint32) % 7
    table_ = pack_table(quantised(np.bincount(tokens)))
    block = bytearray(Coder(table_).encode(tokens))
    for at in (5, 40, len(block) - 1):
        damaged = bytes(block[:at]) + bytes([block[at] ^ 1]) + bytes(block[at + 1 :])
        with pytest.raises(ValueError):
            Coder(table_).decode(damaged)
    with pytest.raises(ValueError):
        Coder(table_[:-5] + b"x" + table_[-4:])
    with pytest.raises(ValueError):
        Coder(pack_table(quantised(np.array([1, 0, 1])))).encode(np.array([0, 1], dtype=np.uint32))


def test_frequencies_fill_the_precision():
    counts = np.array([10**12, 1, 0, 1, 5])
    freq = quantised(counts, 8)
    assert freq.sum() == 256 and (freq[counts > 0] > 0).all() and freq[2] == 0
    assert quantised(np.zeros(3), 4).sum() == 16
    with pytest.raises(ValueError):
        quantised(np.ones(20), 4)


def test_small_blocks_and_odd_rows(spark):
    path = fresh_dir(spark, "store")
    write_store(odd(spark), path, tokenizer_path(), block_tokens=50)
    rows = sorted(read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows) == [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
    expected = sorted([*ids, 1] for ids in plain_ids([r[1] for r in ODD]))
    assert sorted(r["ids"] for r in rows) == expected
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows[:-1])]).tolist()
    assert document_digests(odd(spark, []), tokenizer_path()).count() == 0


END, START = "<|endoftext|>", "<|startoftext|>"
WITH_ADDED = [
    f"a {END} b", f"a{END}b {START}", f"{START}{END}{END}", f"it's{END}'s, x.{START}!? 12{END}3", None, "plain words",
    "<|ENDOFTEXT|> <|EndOfText|>", f"<|endof{END}text|> <|{START}|>", f"\u00e9{END}\u0301 e{START}\t\n ", "",
]


def test_added_tokens_are_recognised(spark):
    assert plain_ids([f"a {END} b"]) == [[320, 49407, 321]]
    flat, lengths = WordEncoder.of(tokenizer_path()).batch(pa.array(WITH_ADDED, pa.string()))
    assert [f.tolist() for f in np.split(flat, np.cumsum(lengths)[:-1])] == plain_ids(WITH_ADDED)
    docs = spark.createDataFrame(list(enumerate(WITH_ADDED)), "doc_id bigint, text string")
    found = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in document_digests(docs, tokenizer_path()).collect()}
    wanted = [[*ids, 1] for ids in plain_ids(WITH_ADDED)]
    assert found == {i: (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for i, ids in enumerate(wanted)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from([END, START, "a", "B'", " ", "<|", "|>", ".", "\u00e9", "7"]), max_size=12).map("".join), max_size=6))
def test_added_tokens_among_anything(texts):
    flat, lengths = WordEncoder.of(tokenizer_path()).batch(pa.array(texts, pa.string()))
    found = np.split(flat, np.cumsum(lengths)[:-1]) if len(texts) else []
    assert [f.tolist() for f in found] == plain_ids(texts)
