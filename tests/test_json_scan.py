"""Whole JSON files cut into elements by splits: against the json module, with splits of a few bytes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from nestgate.sources import json_scan as J
from nestgate.sources import packed_text as P
from nestgate.sources.json import malformed_json, read_json_documents

BAD = {  # files that are not one object or one array of objects
    "two_objects": '{"a":1}\n{"a":2}', "two_on_a_line": '{"a":1}{"a":2}', "pretty_objects": '{\n "a": 1\n}\n{\n "a": 2\n}\n',
    "two_arrays": '[\n {"a":1}\n]\n[\n {"a":2}\n]', "array_and_object": '[{"a":1}] {"a":2}', "empty": "", "blank": " \n ",
    "cut": '[{"a":1},{"a":', "cut_in_string": '[{"a":"x}, {', "garbage_after": '[{"a":1}] x', "garbage_before": 'x [{"a":1}]',
    "scalar": "12", "scalars": '[{"a":1}, 2]', "trailing_comma": '[{"a":1},]', "leading_comma": '[,{"a":1}]',
    "no_comma": '[{"a":1} {"a":2}]', "wrong_bracket": '[{"a":1}}', "extra_close": '[{"a":1}]]', "string": '"abc"',
    "bad_element": '[{"a":1},{"a":}]', "object_in_array_cut": '{"a":[1,2}', "nested_mismatch": '[{"a":[1}]]',
}
GOOD = {
    "array": '[{"a":1},{"a":2}]', "empty_array": "[]", "empty_array_spaced": " [ \n ] \n", "object": '{"a":1}',
    "empty_object": "{}", "nested": '[{"a":{"b":[{"c":"}]"}]}}, {"a":"\\\\"}, {"a":"\\"{["}]',
    "pretty": json.dumps([{"a": {"x": "é}{"}, "b": [1, [2], {}]}, {"a": "\\"}], indent=2) + "\n\n",
    "crlf": '[\r\n{"a":1},\r\n{"a":2}\r\n]\r\n', "tabs": '[\t{"a":1}\t]',
}


def records(text):
    value = json.loads(text)
    return value if isinstance(value, list) else [value]


@pytest.fixture(params=["1g", "60b"])
def split(spark, request):
    """Whole files in a split, and files cut every few bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    if request.param != "1g":
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def write(folder, files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.json").write_bytes(text.encode())
    return str(folder)


def names(rows):
    return {r["file_path"].rsplit("/", 1)[1][:-5] for r in rows}


def test_gate_lists_exactly_the_bad_files(spark, tmp_path, split):
    path = write(tmp_path / "files", BAD | GOOD)
    assert names(malformed_json(spark, path, multiline=True).collect()) == set(BAD)


def test_elements_are_those_of_the_json_module(spark, tmp_path, split):
    path = write(tmp_path / "files", GOOD)
    rows = J.json_elements(spark, path).orderBy("file", "block", "ord").collect()
    found = {n: [] for n in GOOD}
    for r in rows:
        found[r["file"].rsplit("/", 1)[1][:-5]].append(json.loads(r["text"]))
    assert found == {n: records(t) for n, t in GOOD.items()}


def test_packed_files_are_split_and_read_alike(spark, tmp_path, split):
    """Frames of whole lines with a marker after each: also a split that begins within a marker or a frame."""
    files = GOOD | {"long": json.dumps([{"id": i, "t": "}]\\\"" * i} for i in range(40)], indent=1)}
    folder = tmp_path / "files"
    folder.mkdir()
    for name, text in files.items():
        lines = text.splitlines(keepends=True)
        frames = ["".join(lines[i:i + 3]) for i in range(0, len(lines), 3)]
        (folder / f"{name}.txt").write_bytes(b"".join(P.pack(f.encode()) + P.SEPARATOR for f in frames))
    rows = J.json_elements(spark, str(folder), packed=True).orderBy("file", "block", "ord").collect()
    found = {n: [] for n in files}
    for r in rows:
        found[r["file"].rsplit("/", 1)[1][:-4]].append(json.loads(r["text"]))
    assert found == {n: records(t) for n, t in files.items()}


def test_no_record_is_lost_past_the_gate(spark, tmp_path, split):
    several = ("two_objects", "two_on_a_line", "pretty_objects", "two_arrays", "array_and_object")
    path = write(tmp_path / "files", {n: BAD[n] for n in several})
    got = read_json_documents(spark, path, "a long", multiline=True)
    assert sorted(r["a"] for r in got.collect()) == sorted([1, 2] * len(several))
    cut = write(tmp_path / "cut", {n: BAD[n] for n in ("cut", "garbage_after", "bad_element")})
    got = read_json_documents(spark, cut, "a long", multiline=True).collect()
    assert sorted(r["a"] for r in got if r["_corrupt_record"] is None) == [1, 1, 1]
    assert sum(r["_corrupt_record"] is not None for r in got) >= 3


def scan(data, blocks, r):
    """The two steps on one file in this process, its pieces dealt to ``blocks`` splits at random."""
    pieces = data.split(b"}")
    lacking = bool(pieces[-1])
    pieces = pieces if lacking else pieces[:-1]
    cuts = sorted(r.randrange(len(pieces) + 1) for _ in range(blocks - 1))
    splits = [pieces[a:b] for a, b in zip([0, *cuts], [*cuts, len(pieces)])]
    splits = [x for x in splits if x]
    rows = []
    for k, part in enumerate(splits):
        done = J.transition(b"}".join(part))
        rows.append({"file": "f", "block": k, "size": len(data), "n_bytes": len(b"}".join(part)) + 1,
                     "states": [x for t in (done, J.compose(done, J.transition(b"}"))) for state in t for x in state]})
    begins, ends, unended = J._beginnings(rows)
    assert bool(unended) == lacking
    out = []
    for k, part in enumerate(splits):
        cutter = J.Cutter(*begins["f", k])
        for n, piece in enumerate(part):
            cutter.feed((b"}" if n else b"") + piece)
        if ("f", k) not in unended:
            cutter.feed(b"}")
        cutter.finish(("f", k) in ends)
        out += cutter.out
    elements, held = [], None
    for _, kind, left, right, text in out:
        if kind == "element" and (text.strip() or left != J.OPEN_LIST):
            elements.append(text)
        elif kind == "tail":
            held = text
        elif kind == "middle":
            held += text
        elif kind == "head" and ((held + text).strip()):
            elements.append(held + text)
    return elements, [x for x in out if x[1] == "problem"]


def test_random_files_cut_anywhere():
    r = random.Random(4)

    def value(depth):
        k = r.randrange(7 if depth < 3 else 4)
        if k < 4:
            return r.choice([1, -2.5, None, True, "", "a}b", 'q"[', "\\", "é😀{", ",]", "x" * r.randrange(60)])
        return [value(depth + 1) for _ in range(r.randrange(4))] if k == 4 else {
            r.choice(["k", "a.b", "]", '"', "\\"]) + str(i): value(depth + 1) for i in range(r.randrange(4))}
    for i in range(300):
        items = [{"id": n, "v": value(0)} for n in range(r.randrange(30))]
        whole = items if i % 3 else {"only": items}
        data = json.dumps(whole, indent=r.choice([None, 1, 4]), ensure_ascii=r.random() < 0.5).encode() + b"\n" * (i % 2)
        elements, problems = scan(data, r.choice([1, 2, 5, 40]), r)
        assert not problems and [json.loads(x) for x in elements] == (items if i % 3 else [whole])


def test_one_array_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text(json.dumps([{"id": i, "text": "some words } and more " * 20} for i in range(5000)]))   # one line
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        docs = read_json_documents(spark, str(path), "id long, text string", multiline=True, corrupt_col=None)
        per_task = docs.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(per_task) >= 8 and sum(r["count"] for r in per_task) == 5000
        assert docs.agg(F.countDistinct("id")).first()[0] == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_gate(spark, tmp_path):
    lines = ['{"a":1}', "", '{"a":1}{"a":2}', '{"a":1} x', "[1]", "3", '{"a":1}] [{"a":2}', '{"a":1}} {"v":{"a":2}',
             '{"a":1},{"a":2}', '  {"a":{}}  ', '{"a":']
    path = tmp_path / "lines.jsonl"
    path.write_text("\n".join(lines))
    (row,) = malformed_json(spark, str(path)).collect()
    assert row["n_bad"] == 8


def test_transitions_compose():
    r = random.Random(8)
    for _ in range(300):
        data = bytes(r.choice(b'"[]{},ab ') for _ in range(40))
        cut = r.randrange(41)
        assert J.compose(J.transition(data[:cut]), J.transition(data[cut:])) == J.transition(data)
    assert J.compose(J.NOTHING, J.transition(b'[{"')) == J.transition(b'[{"')


def test_a_filter_on_records_parses_no_text_again(spark, tmp_path):
    path = write(tmp_path / "files", GOOD)
    docs = read_json_documents(spark, path, "a string, b string", multiline=True)
    plan = docs.where(F.col("_corrupt_record").isNull())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("MapInArrow") == 2       # elements with problems, and fragments
