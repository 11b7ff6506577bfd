"""Byte-level BPE encoding and decoding (operator 8).

Method: the vocabulary's byte strings are mapped to Latin-1 text and put into
one Aho-Corasick automaton.  For a piece of text the automaton gives the
longest vocabulary entry at every position; encoding walks from the left,
takes the longest entry and steps back to shorter prefixes, or to the entry
before, wherever two neighbours could not have stayed unmerged side by side.
That neighbour test depends on the two entries only and is memoised.  Every
position is refused at most once, so the work is linear in the piece, and the
result is the one the merges by rank give.

Defined cases: a null or empty text has no ids and decodes to nothing; bytes
are taken from the UTF-8 form of the whole text; repeated rows give repeated
results; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.llm.common import map_columns, read

#: Pieces whose ids one task remembers; the memory is emptied when it is full.
PIECE_MEMORY = 300_000
#: Neighbour answers that one task remembers.
PAIR_MEMORY = 500_000
#: Rows whose ids are held at once when ids are returned.
ROWS = 256


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks by byte string, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class ByteBpe:
    """Encoder and decoder for one vocabulary of ranked byte strings."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import ahocorasick

        self.ranks = ranks
        self.bytes = {i: t for t, i in ranks.items()}
        self.length = {i: len(t) for t, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.automaton.add_word(t.decode("latin-1"), (i, len(t) - 1))
        self.automaton.make_automaton()
        #: the next shorter entry that begins an entry, or -1
        self.shorter = {
            i: next((ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ranks), -1)
            for t, i in ranks.items()
        }
        #: the two parts whose merge made an entry; a single byte is its own
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs: dict[int, bool] = {}
        for t, i in sorted(ranks.items(), key=lambda x: x[1]):
            self.parts[i] = (i, i)
            for n in range(1, len(t)):
                a, b = ranks.get(t[:n], i), ranks.get(t[n:], i)
                if a < i and b < i and self._stay(a, b):
                    self.parts[i] = (a, b)
                    self.merged[a, b] = i
                    break

    def _stay(self, a: int, b: int) -> bool:
        """Whether no merge across the border of ``a`` and ``b`` would have
        come before the merges that made them."""
        parts, merged, limit = self.parts, self.merged, 1 << 62
        while True:
            if merged.get((a, b), limit) < limit:
                return False
            if a > b:
                limit, a = a, parts[a][1]
                if a == limit:
                    limit, b = b + 1, parts[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, parts[b][0]
                if b + 1 == limit:
                    limit, a = a, parts[a][1]
                    if a == limit:
                        return True

    def fits(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_MEMORY:
                self.pairs.clear()
            known = self.pairs[key] = self._stay(a, b)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece, as the merges by rank give them."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * (n + 1)
        for end, (i, back) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - back] = i
        length, shorter, pairs = self.length, self.shorter, self.pairs
        refused = bytearray(n + 1)
        ids: list[int] = []
        at, i = 0, longest[0]
        while at < n or i >= 0:
            last = ids[-1] if ids else -1
            while i >= 0:
                to = at + length[i]
                if not refused[to]:
                    if last < 0:
                        break
                    known = pairs.get(last << 32 | i)
                    if known or known is None and self.fits(last, i):
                        break
                i = shorter[i]
            if i >= 0:
                ids.append(i)
                at = to
                i = longest[at]
            elif not ids:
                raise ValueError("a byte of the text is not in the vocabulary")
            else:
                refused[at] = 1
                i = ids.pop()
                at -= length[i]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_CODECS: dict[str, ByteBpe] = {}


def codec(path: str) -> ByteBpe:
    """The vocabulary of a file, built once in each Python worker."""
    if path not in _CODECS:
        _CODECS[path] = ByteBpe(load_ranks(path))
    return _CODECS[path]


def _encoder(bpe: ByteBpe, pattern: str):
    """Ids of a whole text; the ids of recent pieces are remembered."""
    import regex

    split, memory = regex.compile(pattern).findall, {}

    def ids_of(text: str | None) -> list[int]:
        out: list[int] = []
        for piece in split(text) if text else ():
            got = memory.get(piece)
            if got is None:
                if len(memory) >= PIECE_MEMORY:
                    memory.clear()
                got = memory[piece] = bpe.encode_piece(piece.encode())
            out += got
        return out

    return ids_of


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, ids): the ids of each whole text; each match of ``pattern`` is
    encoded on its own.  The rank file is read on the executors."""
    schema = T.StructType(
        [docs.select(key).schema[0], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    )

    def make():
        ids_of = _encoder(codec(ranks_path), pattern)

        def step(columns) -> Iterator[list]:
            # few rows at a time: the ids of long texts take more room than the texts
            for at in range(0, len(columns[0]) if columns else 0, ROWS):
                keys, texts = (c[at : at + ROWS] for c in columns)
                yield [keys, [ids_of(x) for x in texts]]

        return step

    return map_columns(docs.select(key, text), schema, make)


def decode(encoded: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """(key, bytes): the bytes that each row's ids stand for."""
    schema = T.StructType(
        [encoded.select(key).schema[0], T.StructField("bytes", T.BinaryType(), False)]
    )

    def make():
        bpe = codec(ranks_path)

        def step(columns):
            if columns is not None:
                yield [columns[0], [bpe.decode(x or []) for x in columns[1]]]

        return step

    return map_columns(encoded.select(key, "ids"), schema, make)


def round_trip(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): each whole text is encoded
    and its ids are decoded again in the same task, and only the digests of
    both forms leave it (the ids would be several times the text), unless
    ``with_ids`` asks for the column ``ids`` too."""
    schema = T.StructType(
        [
            docs.select(key).schema[0],
            T.StructField("n_tokens", T.LongType(), False),
            T.StructField("ids_sha256", T.StringType(), False),
            T.StructField("decoded_sha256", T.StringType(), False),
            *[T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)][: int(with_ids)],
        ]
    )

    def make():
        bpe = codec(ranks_path)
        ids_of = _encoder(bpe, pattern)
        decimal = {i: str(i) for i in bpe.bytes}.__getitem__

        def step(columns):
            for at in range(0, len(columns[0]) if columns else 0, ROWS):
                keys, texts = (c[at : at + ROWS] for c in columns)
                n, ids_sha, decoded_sha, kept = [], [], [], []
                for s in texts:
                    ids = ids_of(s)
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                    decoded_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                    if with_ids:
                        kept.append(ids)
                yield [keys, n, ids_sha, decoded_sha, *[kept][: int(with_ids)]]

        return step

    return map_columns(docs.select(key, text), schema, make)


def q_op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded, decoded and digested."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


QUERIES = {"op8_byte_bpe": q_op8_byte_bpe}
