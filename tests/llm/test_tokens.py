"""Token files, byte-level BPE and packing against the libraries and exact round trips."""

import hashlib
import os
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stemma.llm import byte_bpe, huffman, packing, queries_tokens, word_ids
from stemma.llm.word_ids import WordIds, token_ids

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = "ab  \n\t'strevé🙂日本1 9!?-́.ABCing tion the<|endoftext|>\x1c Σς"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def words():
    return WordIds(WORDS)


@pytest.fixture(scope="module")
def bytes_known():
    return byte_bpe.ByteIds(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tik(bytes_known):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytes_known.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=80))
def test_word_ids_are_the_librarys(words, library, text):
    assert np.frombuffer(words.encode([text])[0], words.kind).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=80) | st.text(max_size=30))
def test_byte_ids_are_the_librarys(bytes_known, tik, text):
    assert np.frombuffer(bytes_known.encode(text), "<u4").tolist() == tik.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_transducer_gives_the_merges(bytes_known, piece):
    assert bytes_known.transducer.encode(piece) == byte_bpe.merge(piece, bytes_known.ranks)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.lists(st.integers(0, 160), max_size=6))
def test_utf8_stream_cuts_nowhere(text, cuts):
    raw, stream = text.encode("utf-8", "replace").decode().encode(), byte_bpe.Utf8Stream()
    cuts = sorted({0, len(raw), *(c for c in cuts if c < len(raw))})
    assert "".join(stream.feed(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)) + stream.end() == raw.decode()
    broken = byte_bpe.Utf8Stream()
    assert broken.feed(b"a\xff\xe6") + broken.end() == "a��"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=1, max_size=60), st.integers(6, 16))
def test_code_lengths_are_prefix_free_bounded_and_no_worse_than_fixed(weights, limit):
    w = np.array(weights)
    lengths = huffman.code_lengths(w, limit)
    assert lengths.max() <= limit and (0.5**lengths).sum() <= 1
    assert (w * lengths).sum() <= w.sum() * max(1, int(np.ceil(np.log2(len(w)))))


def test_code_lengths_equal_huffman_without_a_tight_limit():
    assert sorted(huffman.code_lengths(np.array([1, 1, 2, 4, 8]), 16)) == [1, 2, 3, 4, 4]
    assert sorted(huffman.code_lengths(np.array([1, 1, 2, 4, 8]), 3)) == [1, 3, 3, 3, 3] or sorted(huffman.code_lengths(np.array([1, 1, 2, 4, 8]), 3)) == [2, 2, 2, 3, 3]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, np.int64), 3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=700))
def test_codes_round_trip(ids):
    ids = np.array(ids)
    symbols, weights = np.unique(ids, return_counts=True)
    codes = huffman.Codes(symbols, huffman.code_lengths(weights))
    assert codes.decode(*codes.encode(ids), len(ids)).tolist() == ids.tolist()


def expected(docs, library):
    rows = docs.select("doc_id", "text").collect()
    return [(r.doc_id, np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")) for r in rows]


def test_files_hold_all_documents_in_order(spark, odd_docs, no_docs, library, tmp_path):
    for k, docs in enumerate((odd_docs, no_docs)):
        huffman.write(token_ids(docs, WORDS), f"{tmp_path}/{k}", block=500)
        found = huffman.read_ids(spark, f"{tmp_path}/{k}").orderBy("start").collect()
        want = expected(docs, library)
        assert Counter((r.doc_id, bytes(r.ids)) for r in found) == Counter((d, x.tobytes()) for d, x in want)
        ids = [-1 if r.doc_id is None else r.doc_id for r in found]
        assert ids == sorted(ids)
        sizes = [len(r.ids) // 4 for r in found]
        assert [r.start for r in found] == np.cumsum([0, *sizes])[:-1].tolist()


def holders(spark):
    """Workers that hold an encoder, and all that were looked at."""

    def look(batches):
        from stemma.llm import common

        rows = sum(b.num_rows for b in batches)
        time.sleep(0.3)  # so that each worker gets a task
        yield pa.RecordBatch.from_arrays([pa.array([os.getpid()] * rows), pa.array([bool(common._HELD)] * rows)], ["pid", "holds"])

    found = spark.range(0, 24, 1, 24).mapInArrow(look, "pid long, holds boolean").collect()
    return {r.pid for r in found if r.holds}, {r.pid for r in found}


def test_steps_after_the_encoder_let_go_of_it(spark, odd_docs, tmp_path):
    huffman.write(token_ids(odd_docs, WORDS), f"{tmp_path}/files", block=500)
    files = spark.read.parquet(f"{tmp_path}/files/blocks").repartition(16)
    files.write.parquet(f"{tmp_path}/many/blocks")
    spark.read.parquet(f"{tmp_path}/files/codebook").write.parquet(f"{tmp_path}/many/codebook")
    steps = (lambda ids: huffman.count_ids(ids.repartition(16)).collect(), lambda ids: huffman.write(ids, f"{tmp_path}/again", block=500), lambda ids: huffman.read_ids(spark, f"{tmp_path}/many").collect())
    for step in steps:
        ids = token_ids(odd_docs, WORDS)
        before, _ = holders(spark)
        step(ids)
        after, seen = holders(spark)
        assert before and (before & seen) - after
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) == word_ids.READ_ROWS


def test_a_worker_gives_idle_memory_back_when_its_task_ends(monkeypatch, odd_docs):
    taken, calls = [], []

    def take(self, function, schema):
        taken.append(function)
        raise InterruptedError

    monkeypatch.setattr(type(odd_docs), "mapInArrow", take)
    with pytest.raises(InterruptedError):
        token_ids(odd_docs, WORDS)
    monkeypatch.setattr(word_ids, "giving_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b", ""]})
    found = taken[0](iter([batch, batch]))
    assert [next(found).num_rows, next(found).num_rows, calls] == [2, 2, []]
    assert not list(found) and calls == [1]
    assert not list(taken[0](iter([])))


def check_pieces(pieces, want):
    sequences, whole = defaultdict(list), Counter()
    for r in pieces:
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.CAPACITY
    rows = [(r.doc_id, r.start, bytes(r.ids), r.doc_tokens) for r in pieces]
    for doc, x in want:
        whole[doc] += len(x)
    assert sum(whole.values()) == sum(len(x[2]) // 4 for x in rows)
    for doc, total in whole.items():
        assert sum(len(x[2]) // 4 for x in rows if x[0] == doc) == total
    return sequences


def test_pieces_hold_each_id_once_without_padding(odd_docs, no_docs, library):
    assert packing.pack(token_ids(no_docs, WORDS)).collect() == []
    want = expected(odd_docs, library)
    pieces = packing.pack(token_ids(odd_docs, WORDS)).collect()
    sequences = check_pieces(pieces, want)
    by_size = {d: x for d, x in want}
    for r in pieces:
        if r.doc_id is not None and r.doc_id != 3:
            assert bytes(r.ids) == by_size[r.doc_id][r.start : r.start + r.length].tobytes() and r.doc_tokens == len(by_size[r.doc_id])
    fills = [sum(r.length for r in own) for own in sequences.values()]
    assert all(n == packing.CAPACITY or n & (n - 1) == 0 for n in fills)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_fillings_are_closest_to_the_room(lengths):
    left = Counter(lengths)
    for used, times in packing.fill(dict(left), 40):
        seed = max(left)
        others = Counter(left)
        others[seed] -= 1
        sums = {0}
        for k, n in others.items():
            for _ in range(n):
                sums |= {s + k for s in sums if s + k <= 40 - seed}
        assert sum(k * n for k, n in used.items()) == seed + max(sums)
        for k, n in used.items():
            left[k] -= n * times
            assert left[k] >= 0
        left = +left
    assert not left


def test_queries_against_the_libraries(spark, sf, library, tik):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    ids = [np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in docs]
    starts = np.cumsum([0, *map(len, ids)])
    want = [(r.doc_id, int(s), len(x), zlib.crc32(x.tobytes())) for r, s, x in zip(docs, starts, ids, strict=False)]
    assert sorted(map(tuple, queries_tokens.op1_token_files(spark, sf).collect())) == want
    of = {r.doc_id: x for r, x in zip(docs, ids, strict=True)}
    for r in queries_tokens.op10_packing(spark, sf).collect():
        assert r.ids_crc32 == zlib.crc32(of[r.doc_id][r.start : r.start + r.length].tobytes())
    own = [(r.doc_id, np.array(tik.encode_ordinary(r.text or ""), "<u4"), (r.text or "").encode()) for r in docs]
    assert sorted(map(tuple, queries_tokens.op5_byte_bpe(spark, sf).collect())) == [(d, len(x), hashlib.sha256(x.tobytes()).hexdigest(), hashlib.sha256(t).hexdigest()) for d, x, t in own]


def test_byte_bpe_of_odd_documents(odd_docs, no_docs, tik):
    run = lambda docs: byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert run(no_docs) == []
    apart = byte_bpe.decode(byte_bpe.encode(odd_docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert Counter(map(str, apart)) == Counter(map(str, run(odd_docs)))
    want = Counter((r.doc_id, np.array(tik.encode_ordinary(r.text or ""), "<u4").tobytes(), (r.text or "").encode()) for r in odd_docs.collect())
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in run(odd_docs)) == want


def test_long_parts_are_not_remembered(monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 40)
    known = word_ids.WordIds(WORDS)
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcéß'1,.") for _ in range(rnd.randint(1, 9))) for _ in range(300)] + ["z" * 5000, "日本" * 400, "Ab1" * 50]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))) for _ in range(80)] + ["x" * 400_000]
    library = Tokenizer.from_file(WORDS)
    found = [np.frombuffer(x, known.kind).tolist() for i in range(0, len(texts), 10) for x in known.encode(texts[i : i + 10])]
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for kind in ("parts", "pieces"):
        assert max(map(len, getattr(known, kind)), default=0) < word_ids.LONGEST


def test_only_pieces_are_remembered_and_common_ones_stay(monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 30)
    known = word_ids.WordIds(WORDS)
    library = Tokenizer.from_file(WORDS)
    for k in range(8):
        texts = [f"same word{'abcdefgh'[i % 8]}{'!' * (i % 5)}{i},\u00a0{k}\u2003Same's \u65e5{i}" for i in range(40)]
        found = [np.frombuffer(x, known.kind).tolist() for x in known.encode(texts)]
        assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert "same" in known.pieces and len(known.pieces) <= 40
    assert all(not p.isascii() for p in known.parts)  # parts that are cut into pieces aren't kept beside them


def test_ends_of_parts_are_told_by_marks_and_not_piece_by_piece(monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 5)
    known = word_ids.WordIds(WORDS)
    assert known.mark not in Tokenizer.from_file(WORDS).get_vocab().values()
    monkeypatch.setattr(np, "fromiter", None)  # pieces were walked one by one for their sizes
    library = Tokenizer.from_file(WORDS)
    for texts in (["it's a b2b deal", "", "a b-c!"], ["one two three four five six seven"], [], ["", " "], ["it's seven"]):
        found = [np.frombuffer(x, known.kind).tolist() for x in known.encode(texts)]
        assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_decoded_many_at_a_time():
    ranks = byte_bpe.load_ranks(RANKS)
    bytes_of = byte_bpe.TokenBytes({r: b for b, r in ranks.items()})
    by_rank = {r: b for b, r in ranks.items()}
    ids = np.random.default_rng(1).integers(0, len(ranks), 5000).astype("<u4")
    assert bytes_of(ids.tobytes()) == b"".join(by_rank[i] for i in ids.tolist())
    assert bytes_of(b"") == b""
    with pytest.raises(KeyError):
        byte_bpe.TokenBytes({0: b"a", 2: b"b"})(np.array([0, 1], "<u4").tobytes())


def test_new_words_are_read_side_by_side_and_not_byte_by_byte(monkeypatch, tik):
    rnd = random.Random(23)
    words = ["".join(rnd.choice(["the", "tion", "er", "é", "q", "日本", "x"]) for _ in range(rnd.randint(3, 8))) for _ in range(400)]
    known = byte_bpe.ByteIds(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(byte_bpe.MergeTransducer, "step", None)  # took most of the time, a call for nearly every byte of a new word
    text = " ".join(words)
    assert np.frombuffer(known.encode(text), "<u4").tolist() == tik.encode_ordinary(text)


def test_strings_side_by_side_give_the_merges_whatever_is_forgotten(monkeypatch, bytes_known):
    rnd = random.Random(29)
    letters = lambda n: bytes(rnd.choice(b"  aabetinorsh-=\n\xc3\xa9") for _ in range(n))
    strings = [letters(rnd.randint(0, 40)) for _ in range(200)] + [rnd.randbytes(rnd.randint(0, 30)) for _ in range(80)] + [b"", b" " * 200, b"=" * 150, b"a" * 256, b"ab" * 90, b"a"]
    want = [byte_bpe.merge(x, bytes_known.ranks) if x else [] for x in strings]
    as_ids = lambda found: [np.frombuffer(x, "<u4").tolist() for x in found]
    assert as_ids(bytes_known.side_by_side.encode(strings)) == want
    assert as_ids(bytes_known.side_by_side.encode(strings[::-1])) == want[::-1]
    assert bytes_known.side_by_side.encode([]) == []
    for name, value in (("SLOTS", 5), ("STATES", 50), ("READ", 300)):
        monkeypatch.setattr(byte_bpe, name, value)
    few = byte_bpe.SideBySide(bytes_known.transducer)
    assert as_ids(few.encode(strings)) == want
    assert len(few.pending) <= 50 + 300 + 256


def test_rounds_of_texts_give_the_librarys_ids(monkeypatch, tik):
    for name, value in (("REMEMBERED", 40), ("TOGETHER", 300), ("LONGEST", 12), ("SIDE_BY_SIDE", 3), ("SIDE_BY_SIDE_BYTES", 20)):
        monkeypatch.setattr(byte_bpe, name, value)
    known = byte_bpe.ByteIds(RANKS, public_tokenizers.PATTERN)
    rnd = random.Random(31)
    words = ["".join(rnd.choice("aebtionérs") for _ in range(rnd.randint(1, 9))) + rnd.choice(["", "", ",", ".", "'s", ".\nTo", "\n", "-9"]) for _ in range(200)] + ["", "it's", "z" * 50, "日本語" * 9, "\t"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(120)] + ["", " ", "\n", " a", "a ", "  a  b", "\u00a0", "a"]
    assert [np.frombuffer(x, "<u4").tolist() for x in known.encode_all(texts)] == [tik.encode_ordinary(x) for x in texts]
    assert known.encode_all([]) == []
    for memory in (known.parts, known.pieces):
        assert len(memory.ids) <= 40 and max(map(len, [*memory.ids, *memory.older]), default=0) < 12
