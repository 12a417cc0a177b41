import gzip
import hashlib
import os

import pytest

from nestgate.llm import warc_write as W

DDL = "page_id long, url string, html string, key string, shard int"


def rows():
    big = "<p>é" + "x" * 300
    out = [(i, f"http://h/{i}?a b\r\n", big if i % 3 == 0 else f"page {i} " * (i % 40), "k", 9) for i in range(120)]
    return out + [(200, None, None, "k", 9), (201, "u", "", "k", 9), (202, "u", "short", "k", 9), (203, "u", "short", "k", 9),
                  (204, "u", "z" * 200000, "k", 9), (None, "u", big, "k", 9), (None, None, None, "k", 9)]


def brute(data):
    first = {}
    for k, _, h, *_ in data:
        b = (h or "").encode()
        if len(b) >= 100 and k is not None:
            first[b] = min(first.get(b, k), k)
    out = []
    for k, _, h, *_ in data:
        b = (h or "").encode()
        to = first.get(b) if first.get(b) != k else None
        out.append((k, len(b), hashlib.sha256(b).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    data = rows()
    got = W.page_records(spark.createDataFrame(data, DDL).repartition(3), str(tmp_path / "a")).collect()
    assert sorted(map(tuple, got), key=str) == brute(data)


def test_files_do_not_depend_on_partitions_and_roll(spark, tmp_path):
    data = [r for r in rows() if r[0] is not None]
    seen = []
    for k in (1, 7):
        out = str(tmp_path / f"p{k}")
        W.write_archives(spark.createDataFrame(data, DDL).repartition(k), "file:" + out, records=30, roll_bytes=1500)
        names = sorted(x for x in os.listdir(out) if x.endswith(".warc.gz"))
        assert not [x for x in os.listdir(out) if x.endswith(".tmp")]
        seen.append({x: open(f"{out}/{x}", "rb").read() for x in names})
    assert seen[0] == seen[1] and len(seen[0]) > 5 and any("-00001." in x for x in seen[0])
    keys = []
    for name in sorted(seen[0]):                      # plain gzip reads the members; order is the key order
        for part in gzip.decompress(seen[0][name]).split(b"WARC/1.1\r\n")[1:]:
            keys.append(int(part.split(b"X-Record-Key: ")[1].split(b"\r\n")[0]))
    assert keys == sorted(r[0] for r in data)


def test_payloads_come_back_and_damage_is_found(spark, tmp_path):
    out = str(tmp_path / "d")
    data = rows()
    W.write_archives(spark.createDataFrame(data, DDL), out)
    got = {r.key: bytes(r.payload).decode() for r in W.read_archives(spark, out, True).collect() if r.payload is not None}
    assert got["204"] == "z" * 200000 and got["0"] == data[0][2]
    name = next(x for x in os.listdir(out) if x.endswith(".warc.gz"))
    raw = bytearray(gzip.decompress(open(f"{out}/{name}", "rb").read()))
    raw[-10] ^= 1
    with pytest.raises(ValueError):
        W.parse(bytes(raw[raw.rindex(b"WARC/1.1\r\n"):]))


def test_equal_rows_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a" * 150, "", 0)] * 3 + [(2, "u", "a" * 150, "", 0)], DDL)
    got = sorted((r.page_id, r.record_type) for r in W.page_records(df, str(tmp_path / "e")).collect())
    assert got == [(1, "response")] * 3 + [(2, "revisit")]
    assert W.page_records(spark.createDataFrame([], DDL), str(tmp_path / "f")).count() == 0


def test_every_record_has_an_id_of_its_own(spark, tmp_path):
    """Also records without key and repeated rows; the folder may come with or without a scheme."""
    rows = [(None, f"u{i}", "x" * i) for i in range(40)] + [(7, "u", "same")] * 5 + [(i, "u", "y") for i in range(10, 20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for out in (str(tmp_path / "plain"), f"file://{tmp_path}/scheme", f"file:{tmp_path}/slash"):
        W.write_archives(df, out, records=8)
        ids = []
        folder = tmp_path / out.rsplit("/", 1)[1]
        for f in sorted(folder.glob("*.warc.gz")):
            with open(f, "rb") as stream:
                ids += [line for raw in W.members(stream) for line in raw.split(b"\r\n\r\n")[0].split(b"\r\n")
                        if line.startswith(b"WARC-Record-ID")]
        assert len(ids) == len(set(ids)) == len(rows)
        assert W.read_archives(spark, out).count() == len(rows)
