import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from odd import ROWS, check_odd

from tidemark.llm import fim


def brute(key, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    p, q = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:p], text[p:q], text[q:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return key, n, "plain", None, None, text
    if h4 % 100 < 20:
        return key, n, "spm", p, q - p, f"<S>{suf}<P>{pre}<M>{mid}"
    return key, n, "psm", p, q - p, f"<P>{pre}<S>{suf}<M>{mid}"


def random_rows(seed=3, n=600):
    rng = random.Random(seed)
    parts = ["a", "é", "中", "🙂", "<", "P", ">", "<P", "S>", "<P>", "<S>", "\n", " ", "\x00", "words "]
    weights = [9, 5, 5, 5, 3, 3, 3, 1, 1, 0.1, 0.1, 2, 5, 1, 9]
    return [(i, "".join(rng.choices(parts, weights, k=rng.choice([0, 1, 2, 3, 8, 40])))) for i in range(n)]


@pytest.mark.parametrize("size", [1, 60, 1 << 21])
def test_transform_and_restore_match_brute_force(spark, monkeypatch, size):
    rows = random_rows()
    data, at = fim._buffers(pa.array([t for _, t in rows]))
    h = np.array([[int(hashlib.sha256(f"1:{k}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for k, _ in rows] for i in range(4)])
    out, made, n, form, prefix, middle = fim.scatter(data, at, h)
    got = [bytes(out[a:b]).decode() for a, b in zip(made, made[1:])]
    want = [brute(*r) for r in rows]
    assert got == [w[5] for w in want] and [fim.FORMS[f] for f in form] == [w[2] for w in want]
    text, back = fim.gather(out, made, form)
    assert (text == data).all() and (back == at).all()
    # through Spark, in slices of any size
    monkeypatch.setattr(fim, "SLICE", size)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    told = fim.restore(fim.transform(docs)).collect()
    assert sorted(tuple(r[:6]) for r in told) == want
    assert {r.doc_id: r.restored for r in told} == dict(rows)


def test_every_form_occurs():
    forms = [brute(i, "some text")[2] for i in range(500)]
    assert {f: forms.count(f) > 20 for f in fim.FORMS} == dict.fromkeys(fim.FORMS, True)


def test_odd_rows(spark):
    got = check_odd(lambda df: fim.restore(fim.transform(df)), spark)
    assert got == sorted(((*brute(r[0], r[1]), r[1] or "") for r in ROWS), key=repr)


def test_rows_read_from_a_slice_of_a_column():
    texts = pa.array(["skipped é", "kept 🙂", None, "also kept"]).slice(1, 3)
    data, at = fim._buffers(texts)
    assert [bytes(data[a:b]).decode() for a, b in zip(at, at[1:])] == ["kept 🙂", "", "also kept"]


def test_restore_keeps_columns_and_refuses_what_no_form_makes(spark):
    made = spark.createDataFrame([("<P>a<S>c<M>b", "psm", 1), ("<S>c<P>a<M>b", "spm", 2), ("abc", "plain", 3), ("<M>", "plain", 4)], "output string, form string, extra int")
    assert [tuple(r) for r in fim.restore(made).orderBy("extra").select("extra", "restored").collect()] == [(1, "abc"), (2, "abc"), (3, "abc"), (4, "<M>")]
    for output, form in (("<P>a<M>b<S>c", "psm"), ("<P>a<S>c", "psm"), ("x<P>a<S>c<M>b", "psm"), ("abc", "other")):
        with pytest.raises(Exception, match="marks|form"):
            fim.restore(spark.createDataFrame([(output, form)], "output string, form string")).collect()
