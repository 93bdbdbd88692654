"""Array files in byte ranges, against Python's own JSON reader and against any cut."""

import json
import random

import pytest
from pyspark.sql import types as T

from listingloom.sources import feeds, json_array
from listingloom.sources.json_array import State, Summary

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def cut(data, step, array=True):
    """Elements as the ranges of ``step`` bytes find them, blocks of three bytes."""
    summaries, found, state = [], [], State()
    blocks = lambda start, end: [(at, data[at : min(at + 3, end)]) for at in range(start, end, 3)]
    escaped = lambda at: (len(data[:at]) - len(data[:at].rstrip(b"\\"))) % 2 == 1
    for start in range(0, len(data), step):
        end = min(start + step, len(data))
        found += json_array.split_elements(iter(blocks(start, len(data))), end, state, escaped(start))
        summaries.append(json_array.summarize((b for _, b in blocks(start, end)), escaped(start)))
        state = summaries[-1].after(state)
    return [text for _, text in found], summaries


def made(pick, depth=0):
    kind = pick.randrange(6 if depth < 3 else 4)
    if kind < 2:
        return "".join(pick.choice(['"', "\\", "[", "]", "{", "}", ",", ":", "é", " ", "\n", "x"]) for _ in range(pick.randrange(8)))
    if kind == 2:
        return pick.choice([None, True, 1.5, -3])
    if kind == 3:
        return pick.choice([[], {}])
    if kind == 4:
        return [made(pick, depth + 1) for _ in range(pick.randrange(4))]
    return {made_key: made(pick, depth + 1) for made_key in ("a,", 'b"', "c\\")[: pick.randrange(4)]}


@pytest.mark.parametrize("step", [1, 2, 5, 7, 64, 10_000])
def test_any_cut_gives_all_elements_once(step):
    pick = random.Random(step)
    for indent in (None, 1):
        values = [made(pick) for _ in range(30)]
        data = json.dumps(values, indent=indent, ensure_ascii=pick.random() < 0.5).encode()
        texts, _ = cut(data, step)
        assert [json.loads(t) for t in texts] == values


def test_summaries_compose_to_that_of_the_whole():
    pick = random.Random(1)
    data = json.dumps([made(pick) for _ in range(40)]).encode()
    _, parts = cut(data, 5)
    whole = json_array.summarize(iter([data]), False)
    joined = Summary(False, 0, 0)
    for part in parts:
        joined = joined.then(part)
    assert joined == whole and whole.after(State()) == State(False, 0)


@pytest.mark.parametrize(
    ("text", "elements"),
    [
        ("[]", []), (" [ \n ] ", []), ("[1,]", ["1", ""]), ("[,1]", ["", "1"]), ("[1, 2", ["1", "2"]), ("", []),
        ('[{"a": nope}, {"a": 2}]', ['{"a": nope}', '{"a": 2}']), ("[1] trailing", ["1"]), ("[1][2]", ["1", "2"]),
        ('["\\\\\\"", "x"]', ['"\\\\\\""', '"x"']), ('[{"a": 1}}, 3]', ['{"a": 1}']),
    ],
)
@pytest.mark.parametrize("step", [1, 3, 100])
def test_odd_and_broken_files(text, elements, step):
    assert [t.decode() for t in cut(text.encode(), step)[0]] == elements


def test_longest_element_is_named():
    with pytest.raises(ValueError, match="byte 1 "):
        list(json_array.split_elements(iter([(0, b'["aaaa'), (6, b"aaaa")]), 10, State(), False, longest=6))


def test_files_of_a_folder(spark, tmp_path):
    rows = [{"a": n, "b": f'q"{n}\\ [,] é'} for n in range(500)]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "one.json").write_text(json.dumps(rows, indent=2), encoding="utf-8")
    (tmp_path / "f" / "two words.json").write_text("﻿" + json.dumps([{"a": -1}, {"a": "text"}, None, 7]), encoding="utf-8")
    (tmp_path / "f" / "record.json").write_text(json.dumps({"a": 1000, "b": "[" * 900}, indent=1))
    (tmp_path / "f" / "none.json").write_text("")
    read = json_array.read_json_array(spark, str(tmp_path / "f"), SCHEMA, feeds.CORRUPT, range_bytes=300)
    assert json_array.read_elements(spark, str(tmp_path / "f"), range_bytes=300).rdd.getNumPartitions() > 40
    got = {(r["a"], r["b"], r[feeds.CORRUPT], r["raw_file"].rsplit("/", 1)[1]) for r in read.collect()}
    expected = {(r["a"], r["b"], None, "one.json") for r in rows} | {
        (1000, "[" * 900, None, "record.json"), (-1, None, None, "two words.json"),
        (None, None, '{"a": "text"}', "two words.json"), (None, None, "null", "two words.json"), (None, None, "7", "two words.json"),
    }
    assert got == expected and read.count() == 505
    assert feeds.read_feed(spark, str(tmp_path / "f"), SCHEMA).columns == ["a", "b", feeds.CORRUPT]


def test_no_files(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    assert feeds.read_feed(spark, str(tmp_path / "none.json"), SCHEMA).count() == 0


def test_same_rows_as_the_multi_line_reader(spark, tmp_path):
    pick = random.Random(9)
    rows = [{"a": n, "b": json.dumps(made(pick))} for n in range(300)]
    path = tmp_path / "x.json"
    path.write_text(json.dumps(rows, indent=3), encoding="utf-8")
    ours = json_array.read_json_array(spark, str(path), SCHEMA, feeds.CORRUPT, range_bytes=777).select("a", "b")
    theirs = spark.read.schema(SCHEMA).option("multiline", True).json(str(path))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_a_range_reads_little_more_than_its_bytes(spark, tmp_path, monkeypatch):
    """64 ranges of a file read about twice the file, not each the megabytes behind it."""
    path = tmp_path / "x.json"
    path.write_text(json.dumps([{"a": n, "b": "x" * 50} for n in range(60_000)]))
    size, taken = path.stat().st_size, []

    class Counted:
        def __init__(self, file):
            self.file = file

        def read_at(self, length, at):
            taken.append(length)
            return self.file.read_at(length, at)

    with json_array.open_file(str(path)) as file:
        counted, found = Counted(file), 0
        step = size // 64 + 1
        states = [State()]
        for start in range(0, size, step):
            blocks = (b for _, b in json_array.read_blocks(file, start, min(start + step, size)))
            states.append(json_array.summarize(blocks, json_array.escaped_at(file, start)).after(states[-1]))
        reader = json_array.RangeReader({"files": "{}"})
        for state, start in zip(states, range(0, size, step)):
            part = json_array.Range(str(path), start, min(start + step, size), size, *state)
            found += sum(batch.num_rows for batch in reader._elements(counted, part))
    assert found == 60_000 and sum(taken) < 6 * size


def test_ranges_are_bounded_in_number(spark, tmp_path, monkeypatch):
    path = tmp_path / "x.json"
    path.write_text(json.dumps([{"a": n, "b": "[\\\"" * (n % 7)} for n in range(3000)]))
    monkeypatch.setattr(json_array, "MOST_RANGES", 20)
    assert json_array.read_elements(spark, str(path), 100).rdd.getNumPartitions() <= 20
    rows = json_array.read_json_array(spark, str(path), SCHEMA, feeds.CORRUPT, 100).select("a", "b").collect()
    assert {r["a"]: r["b"] for r in rows} == {n: "[\\\"" * (n % 7) for n in range(3000)} and len(rows) == 3000
