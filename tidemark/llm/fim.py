"""Fill-in-middle transformation by displacement scatter (operator 13).

A text is cut at two places into prefix, middle and suffix and written anew, so
that a model learns to fill the middle:

* ``psm``    ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``    ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``  the text as it is: one row in ten, the empty text, and every text
  that holds one of the three marks itself (its parts could not be told apart)

Cuts and form come from the SHA-256 of the row's key, so reruns agree and no
row needs to know another.

*Scatter.*  A batch is one array of bytes.  A scan for the bytes that begin a
code point turns the cuts into places in that array.  Every part moves as a
whole, so the shift of its bytes is one number: a difference array gets, at the
first byte of each part, that number less the one before; its running sum is the
shift of every byte of the batch, and one NumPy scatter writes the outputs of
all rows.  Marks are written into the gaps.

*Gather.*  The way back needs outputs and forms only: the marks are found in the
output's bytes, their places give the parts, and the same running sum over the
places of the text says where each of its bytes is gathered from.

Rows are worked on where they are read; nothing is shuffled.  A batch is cut
into slices of about ``SLICE`` bytes (one text at least).

Defined cases: a null text counts as empty; the empty text is plain with n = 0;
a null key is hashed as the empty text; equal rows give equal rows; an empty
table gives an empty table; ``transform`` leaves other columns out and
``restore`` keeps them; an output that its form can't have made is an error;
long texts are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import read

#: Marks of the parts, each of MARK bytes; PLAIN and SPM are per cent of the rows.
PREFIX, SUFFIX, MIDDLE, MARK = b"<P>", b"<S>", b"<M>", 3
PLAIN, SPM = 10, 20
FORMS = ("plain", "psm", "spm")
#: Bytes of text that are worked on at a time.
SLICE = 1 << 21


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as its bytes and each row's first byte (one more at the end)."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def _strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    places = pa.py_buffer(at.astype(np.int64))
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, places, pa.py_buffer(data)]).cast(pa.string())


def _running(starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """The shift of each of ``size`` bytes, from the parts' first bytes (in
    order; parts may be empty) and shifts: a difference array and its sum."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, np.diff(shifts, prepend=0))
    return np.cumsum(steps)[:size]


def _marks(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the marks inside a row, and their rows."""
    if len(data) < MARK:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = np.isin(data[1:-1], np.frombuffer(PREFIX[1:2] + SUFFIX[1:2] + MIDDLE[1:2], np.uint8))
    place = np.flatnonzero((data[:-2] == PREFIX[0]) & kind & (data[2:] == PREFIX[2]))
    row = np.searchsorted(at, place, "right") - 1
    inside = place + MARK <= at[row + 1]
    return place[inside], row[inside]


def _write(out: np.ndarray, places: np.ndarray, mark: bytes) -> None:
    out[places[:, None] + np.arange(MARK)] = np.frombuffer(mark, np.uint8)


def scatter(data: np.ndarray, at: np.ndarray, h: np.ndarray):
    """All rows of a slice: (output bytes, their row starts, code points, form
    numbers, code points of the prefix, of the middle).  ``h``: four numbers a
    row, which choose cuts and form."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(lead, at)
    n = np.diff(first)
    cut_1, cut_2 = np.sort(h[:2] % (n + 1), axis=0)
    form = np.where(h[3] % 100 < SPM, 2, 1)
    form[(n == 0) | (h[2] % 100 >= 100 - PLAIN)] = 0
    form[_marks(data, at)[1]] = 0
    # the parts' places in bytes; a cut at the end is the next row's first byte
    lead = np.append(lead, len(data))
    start, end = at[:-1], at[1:]
    p = np.where(form == 0, end, lead[first[:-1] + cut_1])
    q = np.where(form == 0, end, lead[first[:-1] + cut_2])
    made = np.concatenate([[0], np.cumsum(end - start + 3 * MARK * (form > 0))])
    out_at = made[:-1]
    before, after = p - start, end - q
    to_prefix = out_at + np.select([form == 1, form == 2], [MARK, 2 * MARK + after], 0)
    to_suffix = out_at + np.select([form == 1, form == 2], [2 * MARK + before, MARK], 0)
    to_middle = out_at + 3 * MARK + before + after
    starts = np.stack([start, p, q], axis=1).reshape(-1)
    shifts = np.stack([to_prefix - start, to_middle - p, to_suffix - q], axis=1).reshape(-1)
    out = np.empty(made[-1], np.uint8)
    out[np.arange(len(data)) + _running(starts, shifts, len(data))] = data
    for mark, to in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        _write(out, (to - MARK)[form > 0], mark)
    return out, made, n, form, cut_1, cut_2 - cut_1


def gather(data: np.ndarray, at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that outputs were made from, by their bytes and forms only."""
    start, end = at[:-1], at[1:]
    moved = form > 0
    place, row = _marks(data, at)
    place, row = place[moved[row]], row[moved[row]]
    if len(place) != 3 * moved.sum() or (np.bincount(row, minlength=len(form)) != 3 * moved).any():
        raise ValueError("an output has not the three marks of its form")
    marks = place.reshape(-1, 3)
    wanted = np.where((form[moved] == 1)[:, None], *(np.frombuffer(b"".join(m[1:2] for m in order), np.uint8) for order in ((PREFIX, SUFFIX, MIDDLE), (SUFFIX, PREFIX, MIDDLE))))
    if (data[marks + 1] != wanted).any() or (marks[:, 0] != start[moved]).any():
        raise ValueError("an output has not the marks of its form in their order")
    ends = end[moved]
    one, two, three = (marks + MARK).T
    psm = form[moved] == 1
    prefix = start.copy(), end.copy()
    middle, suffix = (end.copy(), end.copy()), (end.copy(), end.copy())
    prefix[0][moved], prefix[1][moved] = np.where(psm, one, two), np.where(psm, two - MARK, three - MARK)
    suffix[0][moved], suffix[1][moved] = np.where(psm, two, one), np.where(psm, three - MARK, two - MARK)
    middle[0][moved], middle[1][moved] = three, ends
    made = np.concatenate([[0], np.cumsum(end - start - 3 * MARK * moved)])
    p = made[:-1] + prefix[1] - prefix[0]
    q = p + middle[1] - middle[0]
    starts = np.stack([made[:-1], p, q], axis=1).reshape(-1)
    shifts = np.stack([prefix[0] - made[:-1], middle[0] - p, suffix[0] - q], axis=1).reshape(-1)
    return data[np.arange(made[-1]) + _running(starts, shifts, made[-1])], made


def _slices(batch: pa.RecordBatch, texts: pa.Array):
    """Consecutive parts of a batch with about SLICE bytes of text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        held = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, held + SLICE, "right")))
        yield batch.slice(at, to - at)
        at = to


def _numbers(key: Column) -> list[Column]:
    """The first four groups of 8 hexadecimal digits of the key's digest."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row."""
    rows = docs.select(F.col(key), F.col(text).alias("text"), *_numbers(F.col(key)))
    schema = T.StructType(
        [
            docs.select(key).schema[0],
            T.StructField("n", T.LongType(), False),
            T.StructField("form", T.StringType(), False),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType(), False),
        ]
    )

    def run(batches):
        to = to_arrow_schema(schema)
        for whole in batches:
            for batch in _slices(whole, whole.column(1)):
                h = np.stack([batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4)])
                out, made, n, form, prefix, middle = scatter(*_buffers(batch.column(1)), h)
                plain = form == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(FORMS).take(pa.array(form)),
                        pa.array(prefix, pa.int64(), mask=plain),
                        pa.array(middle, pa.int64(), mask=plain),
                        _strings(out, made),
                    ],
                    schema=to,
                )

    return rows.mapInArrow(run, schema)


def restore(rows: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """``rows`` and, as column ``into``, the text that each output was made
    from; only output and form are read for it."""
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.StringType(), False)])
    outputs, forms = rows.columns.index(output), rows.columns.index(form)

    def run(batches):
        to = to_arrow_schema(schema)
        for whole in batches:
            for batch in _slices(whole, whole.column(outputs)):
                kind = pc.index_in(batch.column(forms), pa.array(FORMS))
                if kind.null_count:
                    raise ValueError(f"a form is none of {FORMS}")
                text = _strings(*gather(*_buffers(batch.column(outputs)), kind.to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([*batch.columns, text], schema=to)

    return rows.mapInArrow(run, schema)


def q_op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` transformed and restored, as digests."""
    rows = restore(transform(read(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


_HEX = "('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), {0}, 8))::BIGINT"
SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    {", ".join(f"{_HEX.format(8 * i + 1)} AS h{i + 1}" for i in range(4))} FROM documents),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM docs),
parts AS (SELECT *, left(t, p) AS pre, substr(t, p + 1, q - p) AS mid, substr(t, q + 1, n - q) AS suf FROM cuts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN p::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN (q - p)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

QUERIES = {"op13_fill_in_middle": q_op13_fill_in_middle}
ORACLE_SQL = {"op13_fill_in_middle": SQL}
