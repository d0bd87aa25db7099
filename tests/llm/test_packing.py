from hypothesis import given, settings
from hypothesis import strategies as st

from quirespark.llm import packing

UNITS = "unit_id string, doc_id string, text_nodes array<struct<inline_id: string, source_text: string>>, nodes string"


def brute(sizes, capacity):
    room, place = [], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        for b, r in enumerate(room):
            if r >= sizes[k]:
                break
        else:
            b = len(room)
            room.append(capacity)
        room[b] -= sizes[k]
        place[k] = b
    return place


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=80))
def test_first_fit_decreasing(sizes):
    assert packing.first_fit_decreasing(sizes, 30).tolist() == brute(sizes, 30)


def test_requests(spark):
    units = spark.createDataFrame(
        [
            ("u1", "b", [("i", "x" * 25), ("j", None), ("k", "y" * 6)], "clash"),
            ("u1", "b", [("i", "x" * 25), ("j", None), ("k", "y" * 6)], "clash"),
            ("u2", "b", [("i", "z" * 10), ("i", "z" * 10)], None),
            ("u3", None, [("i", "w")], None),
            ("u4", "e", None, None),
        ],
        UNITS,
    )
    limits = spark.createDataFrame([("s", 10), ("s", 10), ("l", 100), ("none", None), ("zero", 0)], "limit_id string, capacity_chars int")
    out = packing.pack(units, limits, group_items=3).collect()
    assert {r["limit_id"] for r in out} == {"s", "l"} and {r["doc_id"] for r in out} == {"b", None}
    for r in out:
        cap = 10 if r["limit_id"] == "s" else 100
        assert r["used_chars"] == sum(n["chars"] for n in r["nodes"]) <= cap and r["free_chars"] == cap - r["used_chars"]
    small = sorted((n["unit_id"], n["inline_id"], n["part"], n["offset"], n["chars"]) for r in out if r["limit_id"] == "s" for n in r["nodes"])
    assert small == [("u1", "i", 1, 0, 10), ("u1", "i", 2, 10, 10), ("u1", "i", 3, 20, 5), ("u1", "j", 1, 0, 0), ("u1", "k", 1, 0, 6), ("u2", "i", 1, 0, 10), ("u2", "i", 1, 0, 10), ("u3", "i", 1, 0, 1)]
    keys = [(r["doc_id"], r["limit_id"], r["group_no"], r["request_no"]) for r in out]
    assert len(keys) == len(set(keys))
    assert packing.pack(units.limit(0), limits).count() == 0
    assert packing.pack(units, limits.limit(0)).count() == 0


def test_sql_checks(spark, data):
    from collections import Counter
    from pathlib import Path

    import duckdb

    from quirespark.llm import queries

    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    for name, sql in queries.oracle_sql().items():
        df, rel = queries.queries()[name](spark, data), con.sql(sql)
        cols = sorted(df.columns)
        assert cols == sorted(rel.columns)
        at = [rel.columns.index(c) for c in cols]
        assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(tuple(r[k] for k in at) for r in rel.fetchall()), name
