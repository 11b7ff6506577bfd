import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from odd import ROWS, check_odd, documents

from tidemark.llm import bpe

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    own = bpe.codec(RANKS)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    return own, theirs


def test_pieces_match_the_library(both):
    own, theirs = both
    split = regex.compile(P.PATTERN).findall
    rng = random.Random(1)
    parts = ["the", "ing", " ", "  ", "\n", "a", "é", "ß", "中", "🙂", "1", "23", "'s", "!!", "aaaa", "\x00", " "]
    for _ in range(800):
        s = "".join(rng.choices(parts, k=rng.randrange(40)))
        ids = [i for p in split(s) for i in own.encode_piece(p.encode())]
        assert ids == theirs.encode_ordinary(s)
        assert own.decode(ids) == s.encode()


def test_random_bytes_and_long_runs(both):
    own, theirs = both
    rng = random.Random(2)
    for size, low, high in ((300, 97, 103), (100, 0, 256), (60, 32, 127)):
        for _ in range(150):
            s = bytes(rng.randrange(low, high) for _ in range(rng.randint(1, size)))
            assert own.encode_piece(s) == theirs._encode_single_piece(s)
    assert own.decode(own.encode_piece(b"a" * 100_000)) == b"a" * 100_000


def test_another_vocabulary():
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own = bpe.ByteBpe(ranks)
    theirs = tiktoken.Encoding("m", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for s in ("Grüße", " naïveté", "данные", "日本語のテキスト", "xyzzyxyzzy"):
        assert own.encode_piece(s.encode()) == theirs._encode_single_piece(s.encode())


def test_round_trip_of_odd_rows(spark, both):
    _, theirs = both
    got = check_odd(lambda df: bpe.round_trip(df, RANKS, P.PATTERN), spark)
    want = []
    for doc_id, text, *_ in ROWS:
        ids = theirs.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_encode_and_decode_frames(spark):
    docs = documents(spark)
    encoded = bpe.encode(docs, RANKS, P.PATTERN)
    back = {r[0]: bytes(r[1]).decode() for r in bpe.decode(encoded, RANKS).collect()}
    assert back[9] == ROWS[9][1] and back[4] == "" and back[7] == ROWS[7][1]
