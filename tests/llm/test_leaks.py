import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quirespark.llm import fmindex, leaks

from .common import rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=120), st.lists(st.integers(1, 6), min_size=3, max_size=3))
def test_fm_index_finds_every_place(text, phrase):
    t = np.array(text)
    index = fmindex.FMIndex(t, every=4)
    lo, hi = index.search(np.array([phrase]))
    want = [k for k in range(len(t) - 2) if t[k : k + 3].tolist() == phrase]
    assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want


PASSAGE = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]


def items(spark):
    return spark.createDataFrame([(7, "opening line\n" + " ".join(PASSAGE) + "\nclosing?"), (7, "opening line\n" + " ".join(PASSAGE) + "\nclosing?"), (8, "opening line\nshort passage\nclosing?"), (9, None)], "item_id bigint, text string")


def test_altered_passages(spark):
    w = PASSAGE[10:40]
    cases = {
        1: " ".join(w[:20]), 2: " ".join(w[:19]) + " other", 3: " ".join(w[:10] + ["other"] + w[11:20]), 4: " ".join(w[:10] + w[11:20]), 5: " ".join(w[:10] + ["more"] + w[10:20]),
        6: " ".join(w[:6] + ["one"] + w[7:13] + ["two"] + w[14:20]), 7: "<b>" + "</b>\n**".join(w[:20]).upper(), 8: " ".join(x.replace("o", "о") for x in w[:20]), 9: "opening line closing? " * 9, 10: "", 11: None,
        12: "filler " * 5000 + " ".join(w[:12]) + ", " + " ".join(w[12:20]), 13: " ".join(w[:9] + ["a"] + w[10:18] + ["b"] + w[19:27]),
    }
    docs = spark.createDataFrame(list(cases.items()), "doc_id bigint, text string").selectExpr("*", "1 AS item_id")
    assert [r[0] for r in rows(leaks.found(docs, items(spark)), "doc_id")] == sorted([1, 3, 4, 5, 7, 8, 12], key=lambda k: repr((k,)))
    spans = {r["doc_id"]: (r["from_word"], r["to_word"], r["items"]) for r in leaks.removal_spans(docs, items(spark)).collect()}
    assert spans[12] == (5000, 5020, [7]) and spans[1] == (0, 20, [7])
    assert leaks.found(docs.limit(0), items(spark)).count() == 0 and leaks.found(docs, items(spark).limit(0)).count() == 0


def test_same_as_brute_force(spark, data):
    docs, ev = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "eval_items"))
    texts = {r["doc_id"]: leaks.words(r["text"]) for r in docs.select("doc_id", "text").collect() if r["text"]}
    passages = {r["item_id"]: leaks.words("\n".join(r["text"].split("\n")[1:-1])) for r in ev.collect()}
    want = set()
    for d, w in texts.items():
        for i, p in passages.items():
            common = set(w) & set(p)
            if len(common) >= 12 and _longest(w, p, common) >= leaks.WORDS:
                want.add((d, i))
    assert set(rows(leaks.found(docs, ev))) == want


def _longest(w, p, common):
    at = {}
    for k, x in enumerate(p):
        at.setdefault(x, []).append(k)
    run = {}
    for i in range(len(w) - 1, -1, -1):
        if w[i] in common:
            for j in at[w[i]]:
                run[i, j] = 1 + run.get((i + 1, j + 1), 0)
    best = 0
    for (i, j), n in run.items():
        best = max(best, n, *(n + b + run[i + n + a, j + n + b] if (i + n + a, j + n + b) in run else 0 for a, b in ((1, 1), (0, 1), (1, 0))))
    return best


def test_items_in_blocks(spark, monkeypatch):
    other = [w.upper()[::-1] for w in PASSAGE]
    ev = items(spark).union(spark.createDataFrame([(20, "a\n" + " ".join(other) + "\nb")], "item_id bigint, text string"))
    docs = spark.createDataFrame([(1, " ".join(PASSAGE[:25] + other[5:30])), (1, " ".join(PASSAGE[:25] + other[5:30])), (None, " ".join(other[:20]))], "doc_id bigint, text string")
    want = rows(leaks.found(docs, ev))
    assert want == [(1, 20), (1, 7), (None, 20)]
    monkeypatch.setattr(leaks, "BLOCK_ITEMS", 1)
    assert rows(leaks.found(docs, ev)) == want
    monkeypatch.setattr(leaks, "OWNERS", 1)
    assert rows(leaks.found(docs, ev)) == want


def test_markup_of_any_length():
    assert leaks.words('a <b class="' + "x" * 500 + '">c&shy;d</b> &eacute;t&eacute;&nbsp;z &#1072;') == ["a", "cd", "ete", "z", "a"]
