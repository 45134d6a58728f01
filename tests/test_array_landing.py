"""Arrays over many lines, cut at their elements from the depth of brackets before each line."""

import json
import random

import pytest

from sluice.sources import landing as L


def land(spark, root):
    rows = L.variant_landing(spark, root, strip_outer_array=True).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["origin_file_name"], r["origin_file_line"])):
        out.setdefault(r["origin_file_name"].rsplit("/", 1)[1], []).append(r)
    return out


def random_value(r, depth=0):
    kind = r.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return r.choice(["a,b", "x]y", "{", '\\"[', "", "é}", "tab\\t"])
    if kind == 1:
        return r.randint(-5, 5)
    if kind == 2:
        return r.choice([True, False])
    if kind == 3:
        return r.random()
    if kind in (4, 5):
        return {r.choice("abcd,]"): random_value(r, depth + 1) for _ in range(r.randrange(3))}
    return [random_value(r, depth + 1) for _ in range(r.randrange(3))]


@pytest.mark.parametrize("chunk", [2, 65_536])
def test_elements_of_arrays_in_any_layout(spark, tmp, monkeypatch, chunk):
    import os

    monkeypatch.setattr(L, "CHUNK", chunk)
    os.makedirs(tmp + "/in")
    r, want = random.Random(chunk), {}
    for n in range(25):
        items = [random_value(r) for _ in range(r.randrange(6))]
        text = [json.dumps(items, indent=2), "[\n" + ",\n".join(json.dumps(x) for x in items) + "\n]", json.dumps(items, indent=1).replace(",", "\n,"),
                json.dumps(items), "[\n\n" + ", ".join(json.dumps(x) for x in items) + "\n]\n"][n % 5]
        if '"' in text.replace(json.dumps(items), "") and n % 5 == 2 and any("," in json.dumps(x).replace(", ", "") for x in items if isinstance(x, (str, dict, list))):
            text = json.dumps(items, indent=2)  # commas inside strings stay where they are
        with open(f"{tmp}/in/f{n:02d}.json", "w") as f:
            f.write(text)
        want[f"f{n:02d}.json"] = items
    got = land(spark, tmp + "/in")
    for name, items in want.items():
        rows = got.get(name, [])
        assert [x["origin_file_line"] for x in rows] == list(range(1, len(items) + 1)), name
        assert all(x["properties"] is not None for x in rows), name
        assert [json.loads(x["origin_str"]) for x in rows] == items


def test_files_of_other_kinds(spark, tmp):
    import os

    os.makedirs(tmp + "/in")
    files = {"lines.json": '{"a":1}\n[1,2]\n\n"x"\nbad\n[]\n3', "object.json": '{\n"a": [1,\n2]\n}', "broken.json": '[\n{"a":1},\n{"b":', "two.json": '[1,\n2]\n[3,\n4]',
             "empty.json": "[\n]", "bad_element.json": '[\n1,\nnope,\n{"x":1}\n]'}
    for name, text in files.items():
        with open(f"{tmp}/in/{name}", "w") as f:
            f.write(text)
    got = {name: [(r["origin_file_line"], r["origin_str"], r["properties"] is not None) for r in rows] for name, rows in land(spark, tmp + "/in").items()}
    assert got["lines.json"] == [(1, '{"a":1}', True), (2, "1", True), (3, "2", True), (4, '"x"', True), (5, "bad", False), (6, "3", True)]
    assert got["object.json"] == [(1, '{"a":[1,2]}', True)]
    assert [x[2] for x in got["broken.json"]] == [False, False, False]
    assert len(got["two.json"]) == 4 and "empty.json" not in got
    assert [x[1].strip() for x in got["bad_element.json"]] == ["1", "nope", '{"x":1}'] and [x[2] for x in got["bad_element.json"]] == [True, False, True]


def test_a_large_array_is_read_by_many_tasks(spark, tmp):
    import os

    os.makedirs(tmp + "/in")
    with open(tmp + "/in/a.json", "w") as f:
        json.dump([{"k": i, "s": "x" * 30} for i in range(20_000)], f, indent=1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        rows = L.variant_landing(spark, tmp + "/in", strip_outer_array=True)
        got = rows.selectExpr("origin_file_line as n", "variant_get(properties, '$.k', 'long') as k").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["n"], r["k"]) for r in got) == [(i + 1, i) for i in range(20_000)]
