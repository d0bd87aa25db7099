from collections import Counter

import duckdb

from quirespark.llm import repeated_lines as r

from .common import rows


def test_thinning_loses_no_more_than_allowed():
    counts = Counter({k: 1 for k in range(5000)}) + Counter({-1: 100})
    lost = r._thin(counts, 3)
    assert lost == 1 and counts == Counter({-1: 100})
    counts = Counter({k: 5 for k in range(5000)})
    assert r._thin(counts, 3) == 0 and len(counts) == 5000


def docs(spark):
    rows_ = [(k, f"Share this!\nline {chr(97 + k)}x\n\nSHARE - this 12\r\n", "s") for k in range(4)] + [(9, None, "s"), (10, "", "s"), (11, "Share this!", None), (12, "only", "t"), (13, "only", "t"), (14, "only\nonly", "u")]
    return spark.createDataFrame(rows_, "doc_id bigint, text string, source string").selectExpr("*", "'k' AS key", "'g' AS grp")


def test_document_lines(spark):
    d = docs(spark)
    got = rows(r.document_lines(d))
    assert got == sorted(("document_line", "s", f"{k}:{n}") for k in range(4) for n in (1, 4))
    clean = {x["doc_id"]: x["text"] for x in r.strip_repeated(d).collect()}
    assert clean[0] == "line ax\n\n" and clean[9] is None and clean[12] == "only" and len(clean) == 10
    assert r.document_lines(d.limit(0)).count() == 0


def test_page_lines(spark):
    p = spark.createDataFrame([("b", n, f"t{n}", "Edition 3.8") for n in range(1, 4)] + [("b", 1, "t1", "Edition 3.8"), ("b", 5, "x", None), ("b", 6, "y", "12"), ("b", None, "z", "edition"), (None, 1, "q", "a")], "doc_id string, page_number int, primitive_id string, text string")
    assert rows(r.page_lines(p)) == [("page_line", "b", "t1"), ("page_line", "b", "t2"), ("page_line", "b", "t3"), ("page_line", "b", "z")]


def test_same_as_exact_counting(spark, data):
    con = duckdb.connect()
    for t in ("documents", "text_primitives"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    d, p = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "text_primitives"))
    got = rows(r.page_lines(p).unionByName(r.document_lines(d)))
    assert got == sorted(con.sql(r.FOUND_SQL).fetchall(), key=repr)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    d = docs(spark)
    want = rows(r.document_lines(d))
    monkeypatch.setattr(r, "BROADCAST_KEYS", -1)
    assert rows(r.document_lines(d)) == want
