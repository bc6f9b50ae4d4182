"""Array files as a stream of elements, cut anywhere."""

import json
import os
import random

import pytest

from clickweave.sources import json_arrays


def _text(r):
    return "".join(r.choice('{}[]",:\\ab é\n') for _ in range(r.randint(0, 12)))


def _value(r, depth=0):
    kind = r.random()
    if depth > 2 or kind < 0.4:
        return r.choice([_text(r), r.randint(-5, 5), None, True, 1.5])
    if kind < 0.7:
        return {_text(r): _value(r, depth + 1) for _ in range(r.randint(0, 4))}
    return [_value(r, depth + 1) for _ in range(r.randint(0, 3))]


def _event(r):
    return {"event_id": f"e{r.randrange(10**6)}", "x": _value(r), "{": _value(r)}


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _save(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)


def test_elements_equal_the_parsed_array(spark, tmp_dir, small_splits):
    r = random.Random(4)
    arrays = {f"f{k}.json": [_event(r) for _ in range(n)] for k, n in enumerate([0, 1, 2, 300, 500])}
    _save(tmp_dir, {name: json.dumps(rows, indent=r.choice([None, 1, 4]), ensure_ascii=bool(k % 2)) + "\n" * (k % 3)
                    for k, (name, rows) in enumerate(arrays.items())})
    assert json_arrays._pieces(spark, tmp_dir).select("file", "block").distinct().count() > 10  # many tasks read one file
    got = [json.loads(x.value) for x in json_arrays.array_elements(spark, tmp_dir).collect()]
    want = [x for rows in arrays.values() for x in rows]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_plain_elements_and_other_files(spark, tmp_dir):
    _save(tmp_dir, {"mixed.json": '[1, {"a": 1}, "x}", [2, {"b": {}}], null, {"c": "]"}, 7 ]', "object.json": '{"a": {"b": 1}}', "empty.json": "[ ]"})
    got = sorted(x.value for x in json_arrays.array_elements(spark, tmp_dir).collect() if x.value is not None)
    assert [g for g in got if g.startswith("{")] == ['{"a": {"b": 1}}', '{"a":1}', '{"c":"]"}'] and len(got) >= 6


def test_a_broken_element_costs_itself(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F
    from clickweave.sources.json_events import read_raw_events
    good = [{"event_id": f"e{i}", "user_id": "u"} for i in range(20)]
    texts = [json.dumps(x) for x in good]
    texts[7] = '{"event_id": e7, "user_id" "u"}'
    _save(tmp_dir, {"a.json": "[" + ", ".join(texts) + "]", "b.json": '{"event_id": "alone"} x'})
    df = read_raw_events(spark, tmp_dir, "array")
    assert sorted(r.event_id for r in df.where(F.col("_corrupt_record").isNull()).collect()) == sorted(f"e{i}" for i in range(20) if i != 7)
    assert df.where(F.col("_corrupt_record").isNotNull()).count() == 2
    # what never closes comes out in pieces, not as one row
    monkeypatch.setattr(json_arrays, "ELEMENT_BYTES", 100)
    texts[7] = '{"event_id: "e7"}'
    _save(tmp_dir, {"a.json": "[" + ", ".join(texts) + "]", "b.json": "[]"})
    df = read_raw_events(spark, tmp_dir, "array")
    ok = {r.event_id for r in df.where(F.col("_corrupt_record").isNull()).collect()}
    assert ok >= {f"e{i}" for i in range(7)}
    assert max(len(r._corrupt_record) for r in df.where(F.col("_corrupt_record").isNotNull()).collect()) <= 100
