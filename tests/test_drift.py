"""Headers of drifting drops: bounded reads, line breaks in quotes, Parquet layouts."""

import gzip

from ledgerloom.sources import scans
from tests.conftest import rows


def _write(path, data):
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_headers_come_from_the_first_kilobytes(spark, tmpdir_path, monkeypatch):
    read = []
    real = scans._first_record
    monkeypatch.setattr(scans, "_first_record", lambda s, f, start=64: read.append(f) or real(s, f, start))
    _write(f"{tmpdir_path}/x_2601.csv", "﻿k,v\r\n".encode() + b"a,1\n" * 50_000)
    _write(f"{tmpdir_path}/x_2602.csv", b"k,v")  # a header and no row
    _write(f"{tmpdir_path}/x_2603.csv", b"")
    _write(f"{tmpdir_path}/x_2604.csv", ('"v\n1",' + ",".join(f"long{i}" for i in range(60)) + ',k\n2,' + "," * 60 + "b\n").encode())
    _write(f"{tmpdir_path}/x_2605.csv.gz", gzip.compress(b"v,k\n" + b"7,c\n" * 3))
    got = scans.header_rows(spark, f"{tmpdir_path}/x_*")
    assert {k[:6]: len(v) for k, v in got.items()} == {"k,v": 2, '"v\n1",': 1, "v,k": 1} and len(read) == 5
    out, layouts = scans.scan_by_header(spark, f"{tmpdir_path}/x_*", ["k", "v", "V 1"], ["v", "v1"])
    assert len(layouts) == 3
    per = {(r.file_month, r.k): r for r in out.groupBy("file_month", "k").agg({"v": "sum", "v1": "sum"}).collect()}
    assert per[1, "a"]["sum(v)"] == 50_000 and per[4, "b"]["sum(v1)"] == 2 and per[5, "c"]["sum(v)"] == 21


def test_parquet_drops_of_differing_layouts(spark, tmpdir_path):
    spark.createDataFrame([("a", 1.0, 5)], "`K ey` string, v double, w int").write.parquet(f"{tmpdir_path}/t_2601.parquet")
    spark.createDataFrame([("b", 2.0)], "key string, `V ` double").write.parquet(f"{tmpdir_path}/t_2602.parquet")
    spark.createDataFrame([("c",)], "`KEY ` string").write.parquet(f"{tmpdir_path}/t_2603.parquet")
    out = scans.scan_monthly_table(spark, f"{tmpdir_path}/t_*.parquet", fmt="parquet")
    assert rows(out, "file_month", "key", "v", "w") == [(1, "a", 1.0, 5), (2, "b", 2.0, None), (3, "c", None, None)]
    assert sorted(out.columns) == sorted(["key", "v", "w", *scans.FILE_COLUMNS])
