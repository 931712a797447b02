"""Listing, and JSON arrays cut into splits, against Python's own parser."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from takepick.sources.json_arrays import Walk, kind_of
from takepick.sources.listing import expand_paths
from takepick.sources.records import label_files, read_jsonl, read_records


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture
def split_size(spark):
    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def rows_of(spark, paths):
    return [(r.record_index, json.loads(r.j)) for r in read_records(spark, paths).select("record_index", F.to_json("record").alias("j")).orderBy("record_index").collect()]


def some_value(r, depth=0):
    kind = r.randrange(8 if depth < 3 else 5)
    if kind < 2:
        return "".join(r.choice('ab",[]{}\\:é本\n\t ') for _ in range(r.randrange(12)))
    if kind == 5:
        return [some_value(r, depth + 1) for _ in range(r.randrange(4))]
    if kind > 5:
        return {f"k{i}": some_value(r, depth + 1) for i in range(r.randrange(4))}
    return (r.randrange(10**6), None, r.random() < 0.5)[kind - 2]


@pytest.mark.parametrize(("items", "indent", "size"), [(150, None, 150), (80, 1, 200), (60, None, 40), (3, None, 7), (0, 2, 4)])
def test_an_array_in_many_splits(spark, tmp_path, split_size, items, indent, size):
    """Strings hold quotes, commas and brackets, and items are longer and shorter than a split."""
    r = random.Random(items)
    made = [{"id": i, "v": some_value(r), "w": some_value(r)} for i in range(items)]
    path = put(tmp_path / "a.json", " \n" + json.dumps(made, indent=indent, ensure_ascii=indent is None) + "\n ")
    split_size(size)
    assert rows_of(spark, [path]) == list(enumerate(made))


def test_one_array_is_read_by_several_tasks(spark, tmp_path, split_size):
    path = put(tmp_path / "a.json", json.dumps([{"id": i} for i in range(1000)]))
    split_size(1000)
    rows = read_records(spark, [path])
    assert rows.select(F.spark_partition_id()).distinct().count() > 4 and rows.count() == 1000


@pytest.mark.parametrize("bad", ["[", '[{"a":1}', '[{"a":1},', '[{"a":1} {"b":2}]', '[{"a":1}]x', '[,{"a":1}]', '[{"a":1},]', '[{"a":1}],{"b":2}', '[{"a":1}],[{"b":2}]', '[{"a":1}]]', '[{"a":"1}]', "[1]", '[[{"a":1}]]', '[{"a":1},null]'])
def test_what_is_no_array_of_objects_stops(spark, tmp_path, split_size, bad):
    for size in (1 << 20, 5):
        split_size(size)
        with pytest.raises(Exception, match="array|object|JSON|MALFORMED"):
            read_records(spark, [put(tmp_path / "a.json", bad)]).collect()


def test_forms_named_otherwise_and_order(spark, tmp_path):
    files = [
        put(tmp_path / "1.json", '{"id":0}\n\n{"id":1}'),  # lines
        put(tmp_path / "2.jsonl", '[{"id":2},{"id":3}]'),  # an array
        put(tmp_path / "3.jsonl", '\n{\n"id":4\n}'),  # one object
        put(tmp_path / "4.jsonl", "\n \t\n"),
        put(tmp_path / "5.json", '[{"id":5}]'),
        put(tmp_path / "6.jsonl", '{"id":6}'),
        put(tmp_path / "7 {a,b}[c]?*\\.json", '[\n{"id":7}\n]'),
        put(tmp_path / "8.json", ""),
        put(tmp_path / "9.json", '{"id":8,"long":"' + "x" * 9000 + '"}'),
    ]
    got = rows_of(spark, files)
    assert [(i, v["id"]) for i, v in got] == [(i, i) for i in range(9)]
    assert [v["id"] for _, v in rows_of(spark, files[::-1])] == [8, 7, 6, 5, 4, 2, 3, 0, 1]
    assert rows_of(spark, [files[3], files[7]]) == []


def test_forms_are_told_from_a_bounded_head():
    long = b'{"x":"' + b"y" * 20000 + b'"}'
    for content, kind in ((long, "lines"), (long + b"\n" + long, "lines"), (b"[" + long + b"]", "array"), (b'\n\t{"a":1}', "lines"), (b'{\n"a":1}', "object"), (b" \n\t", "empty")):
        assert kind_of(content.lstrip()[:4096]) == kind


def test_walk_knows_strings():
    text = r'{"a\\":"\"],","b":[1,{"c":"\\\\"}]},2'.encode()
    at, sign, depth = Walk(0, 1)(text)
    outside = [(c, d) for c, d in zip(bytes(sign.astype("u1").tolist()).decode(), depth.tolist())]
    assert outside == [("{", 2), (",", 2), ("[", 3), (",", 3), ("{", 4), ("}", 3), ("]", 2), ("}", 1), (",", 1)]
    cut = text.index(b",") + 1  # within the string of quotes and brackets
    again = Walk(1, 2)
    again(text[cut:])
    assert (again.inside, again.depth) == (0, 1)


def test_listing(spark, tmp_path):
    for name in ("d/b.json", "d/a.json", "d/c.jsonl", "d/d.txt", "d/.e.json", "d/sub/f.json", "d/g[1].json", "d/h{x}.json"):
        put(tmp_path / name, "")
    os.symlink(tmp_path / "d/a.json", tmp_path / "link.json")
    names = lambda *v: [os.path.basename(p) for p in expand_paths(spark, [f"{tmp_path}/{x}" for x in v])]
    assert names("d") == ["a.json", "b.json", "g[1].json", "h{x}.json", "c.jsonl"]
    assert names("d/[!ab].*") == ["c.jsonl", "d.txt"] and names("d/*.json", "link.json", "d/../d/d.txt") == ["a.json", "b.json", "g[1].json", "h{x}.json", "d.txt"]
    assert names("d/g[1].json", "d/.e*", "none*.json", "d/h{x}.js*") == ["g[1].json", ".e.json", "none*.json", "h{x}.json"]
    assert expand_paths(spark, [f"file://{tmp_path}/d/sub"]) == [f"{tmp_path}/d/sub/f.json"]
    with pytest.raises(FileNotFoundError):
        read_records(spark, expand_paths(spark, [f"{tmp_path}/none.json"]))


def test_a_file_system_that_only_spark_reads(spark, tmp_path):
    put(tmp_path / "in/1.json", '[{"id":0},{"id":1}]')
    put(tmp_path / "in/2.jsonl", '{"id":2}\n{"id":3}')
    put(tmp_path / "in/3.json", '{\n"id":4}')
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}/in")
    files = expand_paths(spark, ["viewfs://store/in"])
    assert files == [f"viewfs://store/in/{n}" for n in ("1.json", "3.json", "2.jsonl")]
    rows = read_records(spark, files).orderBy("record_index")
    assert [r.source_json for r in rows.collect()] == [files[0]] * 2 + [files[1]] + [files[2]] * 2
    assert [v["id"] for _, v in rows_of(spark, files)] == [0, 1, 4, 2, 3]
    assert label_files(spark, "viewfs://store/in", "*.jsonl") == files[2:]
    assert read_jsonl(spark, [files[2], "viewfs://store/in/none"], "id int").count() == 2


def test_the_plan_does_not_grow_with_files(spark, tmp_path):
    def plan(n):
        for i in range(n):
            put(tmp_path / f"in{n}/{i:05}.jsonl", '{"id":%d}' % i)
        rows = read_records(spark, expand_paths(spark, [f"{tmp_path}/in{n}"]))
        assert rows.count() == n
        return len(rows._jdf.queryExecution().optimizedPlan().toString())

    assert plan(1500) < plan(3) + 500
