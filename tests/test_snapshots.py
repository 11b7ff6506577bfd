"""Pretty-printed documents, one per file: read once, whole, digit by digit."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources.snapshots import CORRUPT, read_snapshots, stream_snapshots

CODES = 3000


def _put(where, name, text, encoding="utf-8"):
    os.makedirs(where, exist_ok=True)
    with open(f"{where}/{name}", "w", encoding=encoding, newline="") as fh:
        fh.write(text)
    return where


def _pretty(codes=2, **more):
    doc = {"result": "success", "time_last_update_unix": 1, "conversion_rates": {f"c{i}": i + 0.25 for i in range(codes)}}
    return json.dumps(doc | more, indent=2)


def _read_bytes(spark):
    """Bytes that this (local) session's JVM has read through file systems."""
    stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in stats)


@pytest.mark.parametrize("quarantine", [False, True])
def test_a_documents_numbers_do_not_open_its_file_again(spark, tmp_dir, quarantine):
    where = _put(f"{tmp_dir}/one", "a.json", _pretty(CODES))
    before = _read_bytes(spark)
    rates = read_snapshots(spark, where, quarantine=quarantine).collect()[0]["conversion_rates"]
    # with an opened file for each number: about 5 kB times CODES
    assert _read_bytes(spark) - before < 10 * os.path.getsize(f"{where}/a.json")
    assert len(rates) == CODES and rates[f"c{CODES - 1}"] == f"{CODES - 1}.25"


def test_a_stream_of_documents_does_not_open_them_again(spark, tmp_dir):
    where = _put(f"{tmp_dir}/one", "a.json", _pretty(CODES))
    before = _read_bytes(spark)
    rows = stream_snapshots(spark, where).select(F.explode("conversion_rates").alias("code", "rate"))
    q = rows.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option(
        "checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    assert _read_bytes(spark) - before < 30 * os.path.getsize(f"{where}/a.json")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == CODES


def test_whole_files_give_what_multi_line_mode_gives(spark, tmp_dir):
    from tidemark.sources.snapshots import CHECKED_SCHEMA

    long = _pretty().replace("0.25", "12345678901234567.12340")
    texts = {
        "plain": _pretty(), "digits": long, "crlf": long.replace("\n", "\r\n"), "array": f"[{_pretty()},\n{_pretty()}]",
        "empty": "", "blank": " \n\n", "cut": _pretty()[:-9], "zeros": "\0" * 99, "zeros_after": _pretty() + "\0" * 99,
        "number": "12", "lines": "no\njson\n", "control": '{"base_code": "a\nb"}', "type": _pretty(time_last_update_unix="x"),
    }
    for name, text in texts.items():
        where = _put(f"{tmp_dir}/{name}", "a.json", text)
        want = spark.read.schema(CHECKED_SCHEMA).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT).json(where)
        got = read_snapshots(spark, where, quarantine=True)
        assert got.collect() == want.collect(), name
        bad = [r for r in want.collect() if r[CORRUPT] is not None]
        if bad:
            with pytest.raises(Exception, match="[Mm]alformed"):
                read_snapshots(spark, where).collect()
        else:
            assert read_snapshots(spark, where).collect() == want.drop(CORRUPT).collect(), name


@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-be", "utf-32", "utf-32-be"])
def test_a_document_that_is_not_utf8_is_malformed(spark, tmp_dir, encoding):
    where = _put(f"{tmp_dir}/one", "a.json", _pretty(), encoding)
    with pytest.raises(Exception, match="[Mm]alformed"):
        read_snapshots(spark, where).collect()
    assert all(r[CORRUPT] for r in read_snapshots(spark, where, quarantine=True).collect())


def test_a_split_file_is_one_document(spark, tmp_dir):
    where = _put(f"{tmp_dir}/one", "a.json", _pretty(CODES))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = read_snapshots(spark, where)
        assert got.rdd.getNumPartitions() > 1
        assert [len(r["conversion_rates"]) for r in got.collect()] == [CODES]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_multiline_landing_has_documents_of_bounded_size(spark, tmp_dir, monkeypatch):
    from tidemark.plans import catalog_io

    rows = [(s, dt.datetime(1995, m, 3), s + m / 4) for s in range(60) for m in (1, 2, 3) for _ in range(2)]
    spark.createDataFrame(rows, "l_suppkey bigint, l_shipdate timestamp_ntz, l_extendedprice double").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.range(60).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_dir}/supplier.parquet")
    monkeypatch.setattr(catalog_io, "FILE_CODES", 10, raising=False)
    monkeypatch.setattr(catalog_io, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    got = catalog_io.q_multiline_landing(spark, tmp_dir)
    want = {(str(s), dt.datetime(1995, m, 1), 2 * (s + m / 4)) for s, m in {(r[0], r[1].month) for r in rows}}
    assert got.count() == len(want) and {tuple(r) for r in got.collect()} == want
    files = [f"{d}/{f}" for d, _, fs in os.walk(f"{tmp_dir}/raw") for f in fs if f.endswith(".txt")]
    documents = [json.load(open(f))["conversion_rates"] for f in files]  # one document a file
    assert len(documents) > 3 * 3 and max(map(len, documents)) < 30


def test_a_claim_whose_rival_is_gone_at_once_is_not_an_error(spark, tmp_dir, monkeypatch):
    from tidemark.sources import ledger

    at = ledger._at

    class Rival:  # removes its note right after it was in the way
        def __init__(self, fs):
            self.fs = fs

        def create(self, path, overwrite):
            try:
                return self.fs.create(path, overwrite)
            except Exception:
                self.fs.delete(path, True)
                raise

        def __getattr__(self, name):
            return getattr(self.fs, name)

    ledger.put(spark, tmp_dir, "now", "other 0")
    monkeypatch.setattr(ledger, "_at", lambda *a: (at(*a)[0], Rival(at(*a)[1])))
    assert ledger.claim(spark, tmp_dir, "now", "mine") is False
    assert ledger.claim(spark, tmp_dir, "now", "mine") is True
