import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from panewise.llm import bpe, tokenfile
from panewise.llm.common import shared_path

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBpe(bpe.load_ranks(RANKS), P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def odd_texts():
    rng = random.Random(5)
    out = ["", " ", "\n\n", "a", "a" * 3001, "ab" * 4000, "  two  blanks \n\n x\t\ty ", "it's we'll I'd 'tis", "日本語のテキスト" * 40, "\x00\x1c \x85  x", "é" * 999, "<|endoftext|> text"]
    out += ["".join(rng.choice("aab c\n'") for _ in range(400)) for _ in range(30)]
    out += ["".join(chr(rng.choice([97, 98, 32, 10, 233, 0x4E00, 0x1F600, 39, 48, 0x301])) for _ in range(300)) for _ in range(60)]
    return out


def test_encoding_matches_the_library(coder, reference, prose):
    texts = [*odd_texts(), prose(1, 4000)]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert coder.decode(ids).decode() == text


def test_merging_alone_and_together_agree(coder):
    rng = random.Random(9)
    pieces = ["".join(rng.choice("theinrsa") for _ in range(rng.randint(1, 40))).encode() for _ in range(400)]
    assert coder.merge(pieces) == [np.array(coder.merge_one(p), "<u4").tobytes() for p in pieces]


def test_lower_rank_that_appears_later_goes_first():
    # ab < bc in rank of the parts, but abc has the lowest rank of all pairs once bc exists
    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"bc": 300, b"abc": 0, b"cb": 301, b"cbc": 1}
    coder, want = bpe.ByteBpe(ranks, P.PATTERN), tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcbc", "bcbcabcb", "abcabc", "cbcbcbc"):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == want.encode_ordinary(text)


def test_rank_queue_finds_the_lowest_rank():
    queue, rng = bpe.RankQueue(5000), random.Random(2)
    ranks = [rng.randrange(5000) for _ in range(500)]
    for i, r in enumerate(ranks):
        queue.push(r, i)
    seen = []
    while (r := queue.first()) >= 0:
        seen += [r] * len(queue.take(r))
    assert seen == sorted(ranks)


def test_round_trip_frame(frame, reference):
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(None, "no id"), (7, None), (7, None), (500, "twice"), (500, "twice")]
    df = frame(rows, "doc_id long, text string", extra=("ids", "n_tokens"))
    got = sorted(map(tuple, bpe.round_trip(df, RANKS, P.PATTERN).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    coded = bpe.encode(df, RANKS, P.PATTERN)
    back = {(r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode(coded, RANKS, P.PATTERN).collect()}
    assert back == {(i, t or "") for i, t in rows}
    assert bpe.round_trip(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_chunk_memory_is_bounded_and_keeps_what_is_met(reference, prose, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_MEMORY", 500)
    coder, learned = bpe.ByteBpe(bpe.load_ranks(RANKS), P.PATTERN), []
    learn = coder.learn
    monkeypatch.setattr(coder, "learn", lambda chunks: learned.extend(chunks) or learn(chunks))
    long = "x" * (bpe.LONG_CHUNK + 1)
    for part in range(30):
        texts = [f"always here w{part}a{i} z{part}b{i}" for i in range(100)] + [f"always {long}"] * (part == 7)
        for text, ids in zip(texts, coder.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert len(coder.chunks) + len(coder.older) <= 2 * (500 + 203)
    assert learned.count(" here") == learned.count("always") == 1  # rare chunks go, and a very long one takes none along
    assert not any(long in c for c in (*coder.chunks, *coder.older))


def test_parts_of_a_batch_are_small():
    import pyarrow as pa

    batch = pa.record_batch({"id": pa.array(range(40)), "text": pa.array(["word " * 50_000] * 39 + ["y" * 9_000_000])})
    parts = list(bpe._parts(batch, 1))
    assert sum(p.num_rows for p in parts) == 40
    assert all(p.num_rows == 1 or p.num_rows * 250_000 <= 4_000_000 for p in parts)  # what a worker holds follows the part


def test_elias_fano():
    rng = random.Random(1)
    for values in ([], [0], [5], [0, 0, 0], [1, 1, 2, 1 << 40], sorted(rng.randrange(10**6) for _ in range(1000)), list(range(300))):
        ef = tokenfile.EliasFano.build(np.array(values, np.int64))
        again = tokenfile.EliasFano(ef.n, ef.low_bits, ef.low.tobytes(), ef.high.tobytes(), ef.samples.tobytes())
        assert again.values().tolist() == values == [again.select(i) for i in range(len(values))]
    size = sum(len(x) for x in (ef.low, ef.high)) * 8
    assert size <= 300 * 4
    with pytest.raises(ValueError):
        tokenfile.EliasFano.build(np.array([2, 1]))


SPECIAL = ["hello <|endoftext|> world", "Hello<|endoftext|>World.", "<|EndOfText|> A <|ENDOFTEXT|>", "a<|startoftext|><|endoftext|>!", "<|endoftext", "<| endoftext |>", "É<|endoftext|>É..", "<|endoftext|>\n<|endoftext|>"]


@pytest.mark.parametrize("ordinary", [False, True])
def test_token_file(spark, frame, prose, ordinary):
    texts = [*odd_texts(), prose(1, 3000), "Mixed CASE Ünï don't 123 !!", None, "é á", *SPECIAL]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    df = frame(rows, "doc_id long, text string", extra=("start", "ids"))
    path = shared_path(spark, "test-tokens")
    tokenfile.write(df, path, WORDS, 1, block_ids=700, **({"ordinary_specials": True} if ordinary else {}))
    blocks = tokenfile.read(spark, path)
    got = {r.doc_id: r for r in tokenfile.digests(blocks).collect()}
    whole = {r.doc_id: bytes(r.ids) for r in tokenfile.documents(blocks).collect()}
    library, start = Tokenizer.from_file(WORDS), 0
    if ordinary:
        library.encode_special_tokens = True
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert whole[i] == ids.tobytes()
        start += len(ids)
    assert len(got) == len(rows)


def test_added_tokens_are_sought_once_a_text(monkeypatch):
    with open(WORDS, encoding="utf-8") as f:
        coder = tokenfile.WordEncoder(f.read(), False)
    calls, has = [], coder._has_added
    monkeypatch.setattr(coder, "_has_added", lambda text: calls.append(text) or has(text))
    texts = [" ".join(f"Word{chr(97 + i)}{chr(97 + j)}{k}ab," for j in range(26)) for k in range(2) for i in range(26)]
    library = Tokenizer.from_file(WORDS)
    for mixed in (texts, [*texts, *SPECIAL, "New<|endoftext|>. Newer."]):
        calls.clear()
        got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode([t.encode() for t in mixed])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in mixed]
        if mixed is texts:
            assert len(calls) == len(texts)


def test_token_file_empty_and_repeated(spark, frame):
    df = frame([(5, "b"), (5, "b"), (None, "a"), (1, None)], "doc_id long, text string")
    path = shared_path(spark, "test-tokens")
    tokenfile.write(df, path, WORDS, 1)
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in tokenfile.digests(tokenfile.read(spark, path)).collect())
    assert got == [(0, 2, None), (2, 1, 1), (3, 2, 5), (5, 2, 5)]
    path = shared_path(spark, "test-tokens")
    tokenfile.write(df.limit(0), path, WORDS, 1)
    assert tokenfile.digests(tokenfile.read(spark, path)).count() == 0


def test_worker_drops_the_coder_when_it_turns_to_another_operator():
    from panewise.llm.common import give_back

    bpe._coder(("key", bpe.load_ranks(RANKS), P.PATTERN))
    give_back(bpe._CODERS)
    assert list(bpe._CODERS) == ["key"]
    give_back()
    assert not bpe._CODERS
