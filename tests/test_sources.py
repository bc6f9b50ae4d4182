"""Raw JSON reading: layouts, malformed records, loose types, time forms."""

import gzip
import json
import os

from pyspark.sql import functions as F

from clickweave.operators import quality
from clickweave.plans.batch import transform, typed_numbers
from clickweave.sources.json_events import read_raw_events

GOOD = [
    {"event_id": "e1", "user_id": "u1", "session_id": "s1", "event_type": "page_view",
     "timestamp": "2025-12-23T10:00:00.000Z"},
    {"event_id": "e2", "user_id": "u1", "session_id": "s1", "event_type": "purchase",
     "timestamp": "2025-12-23T10:00:05.000+00:00", "product_id": "p1", "price": 9.5,
     "quantity": 2},
    {"event_id": "e3", "user_id": "u2", "event_type": "search",
     "timestamp": "2025-12-23T15:30:00.000+05:30"},
]


def _write(path, name, text, gz=False):
    os.makedirs(path, exist_ok=True)
    full = os.path.join(path, name)
    if gz:
        with gzip.open(full + ".gz", "wt") as f:
            f.write(text)
    else:
        with open(full, "w") as f:
            f.write(text)


def test_lines_and_array_layouts_agree(spark, tmp_dir):
    lines_dir, array_dir = os.path.join(tmp_dir, "lines"), os.path.join(tmp_dir, "array")
    _write(os.path.join(lines_dir, "year=2025", "month=12", "day=23"), "part",
           "\n".join(json.dumps(r) for r in GOOD) + "\n", gz=True)
    _write(array_dir, "sample.json", json.dumps(GOOD, indent=2))
    a = read_raw_events(spark, lines_dir, "lines")
    b = read_raw_events(spark, array_dir, "array")
    cols = ["event_id", "user_id", "event_type", "timestamp", "price", "quantity"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
    assert a.where(F.col("_corrupt_record").isNotNull()).count() == 0
    assert "year" not in a.columns  # arrival folders are not columns


def test_broken_line_is_isolated(spark, tmp_dir):
    text = json.dumps(GOOD[0]) + "\n{not json\n\n" + json.dumps(GOOD[2]) + "\n"
    _write(tmp_dir, "mixed.json", text)
    df = read_raw_events(spark, tmp_dir)
    assert df.count() == 3  # the blank line is not a record
    bad = df.where(F.col("_corrupt_record").isNotNull()).collect()
    assert [r._corrupt_record for r in bad] == ["{not json"]
    # the count does not depend on which columns are read
    assert df.select("event_id").where(F.col("event_id").isNotNull()).count() == 2
    assert quality.count_corrupt(df).first().corrupt_records == 1


def test_loose_types_keep_the_row(spark, tmp_dir):
    rows = [
        '{"event_id":"a","user_id":"u","event_type":"purchase","timestamp":"2025-12-23T10:00:00Z","price":"9.5"}',
        '{"event_id":"b","user_id":"u","event_type":"purchase","timestamp":"2025-12-23T10:00:00Z","quantity":1.0}',
        '{"event_id":"c","user_id":"u","event_type":"purchase","timestamp":"2025-12-23T10:00:00Z","quantity":"abc"}',
        '{"event_id":"d","user_id":123,"event_type":"x","timestamp":"2025-12-23T10:00:00Z","additional_data":{"k":[1,2]}}',
    ]
    _write(tmp_dir, "loose.json", "\n".join(rows))
    df = typed_numbers(quality.drop_corrupt(read_raw_events(spark, tmp_dir)))
    got = {r.event_id: r for r in df.collect()}
    assert len(got) == 4
    assert got["a"].price == 9.5
    assert got["b"].quantity == 1
    assert got["c"].quantity is None
    assert got["d"].user_id == "123"
    assert json.loads(got["d"].additional_data) == {"k": [1, 2]}


def test_time_forms_and_bad_time(spark, tmp_dir):
    rows = [
        {"event_id": "z", "user_id": "u", "session_id": "s", "event_type": "page_view",
         "timestamp": "2025-12-23T10:00:00.000Z"},
        {"event_id": "o", "user_id": "u", "session_id": "s", "event_type": "page_view",
         "timestamp": "2025-12-23T10:00:00.000+00:00"},
        {"event_id": "i", "user_id": "u", "session_id": "s", "event_type": "page_view",
         "timestamp": "2025-12-23T15:30:00.000+05:30"},
        {"event_id": "g", "user_id": "u", "session_id": "s", "event_type": "page_view",
         "timestamp": "garbage"},
    ]
    _write(tmp_dir, "t.json", "\n".join(json.dumps(r) for r in rows))
    cur = {r.event_id: r for r in transform(read_raw_events(spark, tmp_dir)).collect()}
    for k in "zoi":
        assert (cur[k].year, cur[k].month, cur[k].day, cur[k].hour) == ("2025", "12", "23", 10)
    assert cur["g"].year is None and cur["g"].hour is None
    # bad time sorts first; equal instants are ordered by event id
    assert [cur[k].event_sequence for k in "gioz"] == [1, 2, 3, 4]


def test_missing_product_columns_in_batch(spark, tmp_dir):
    rows = [{"event_id": "e", "user_id": "u", "event_type": "login",
             "timestamp": "2025-01-02T03:04:05Z"}]
    _write(tmp_dir, "p.json", json.dumps(rows[0]))
    (r,) = transform(read_raw_events(spark, tmp_dir)).collect()
    assert r.has_product_data is False and r.has_price_data is False
    assert (r.month, r.day, r.event_category) == ("01", "02", "engagement")
    assert r.event_sequence == 1 and r.is_session_start is True


def test_required_fields_sequential_counts(spark, tmp_dir):
    rows = [
        {"event_id": "a", "user_id": None, "event_type": "x", "timestamp": "2025-01-01T00:00:00Z"},
        {"event_id": "b", "user_id": None, "event_type": None, "timestamp": "2025-01-01T00:00:00Z"},
        {"event_id": None, "user_id": "u", "event_type": "x", "timestamp": "2025-01-01T00:00:00Z"},
        {"event_id": "c", "user_id": "", "event_type": "x", "timestamp": "2025-01-01T00:00:00Z"},
    ]
    _write(tmp_dir, "r.json", "\n".join(json.dumps(r) for r in rows))
    df = quality.drop_corrupt(read_raw_events(spark, tmp_dir))
    c = quality.null_counts(df).first()
    # b has two NULLs but is counted once, under the first failing field
    assert (c.null_event_id, c.null_user_id, c.null_event_type, c.null_timestamp) == (1, 2, 0, 0)
    kept = quality.require_fields(df).collect()
    assert [r.event_id for r in kept] == ["c"]  # empty strings pass


def test_spread_lines_gives_same_rows(spark, tmp_dir):
    big = "\n".join(json.dumps(dict(GOOD[0], event_id=f"e{i}")) for i in range(500))
    _write(tmp_dir, "big", big, gz=True)
    a = read_raw_events(spark, tmp_dir)
    b = read_raw_events(spark, tmp_dir, spread_lines=True)
    assert sorted(r.event_id for r in a.collect()) == sorted(r.event_id for r in b.collect())
