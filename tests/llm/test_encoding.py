import base64

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirespark.llm import budget, encoding
from quirespark.llm.bpe import PATTERN, Encoder, RankQueue

from .common import RANKS, needs_vocabulary, rows


@pytest.fixture(scope="module")
def pair():
    import tiktoken

    raw = open(RANKS, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return Encoder(raw), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_rank_queue_pops_in_order():
    q = RankQueue(50_000)
    ranks = [49_999, 3, 70_00 // 1, 3, 64, 0, 4096]
    for k, r in enumerate(ranks):
        q.push(r, k)
    got = []
    while q.top:
        got.append(q.pop())
    assert [r for r, _ in got] == sorted(set(ranks)) and dict(got)[3] == [1, 3]
    assert not any(q.low) and not any(q.mid)


HARD = ["", " ", "  ", "\n", "a", "<|endoftext|>", "a  b   c", "x \n y", "\r\n\r\n", "aaaa" * 500, "ё" * 300, "𝔘👩‍🚀 №", "don't we've", "tab\there ", "   nbsp", "12345 678", "\x00\x1f"]


@needs_vocabulary
def test_same_ids_as_the_library(pair):
    own, lib = pair
    ids, counts = own.encode_batch(HARD)
    got = np.split(ids, np.cumsum(counts)[:-1])
    assert [g.tolist() for g in got] == [lib.encode_ordinary(t) for t in HARD]
    assert own.count_batch(HARD).tolist() == counts.tolist()


@needs_vocabulary
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab e\n\t  12.,é—я'sT"), max_size=40), min_size=1, max_size=6))
def test_random_texts(pair, texts):
    own, lib = pair
    ids, counts = own.encode_batch(texts)
    assert [g.tolist() for g in np.split(ids, np.cumsum(counts)[:-1])] == [lib.encode_ordinary(t) for t in texts]


@needs_vocabulary
def test_long_pretoken_is_fast(pair):
    own, lib = pair
    raw = "abcabd" * 20_000
    assert own.slow(raw)[:50] == lib.encode_ordinary(raw[:300])[:50]
    assert b"".join(own.tokens[i] for i in own.slow(raw)).decode() == raw


@needs_vocabulary
def test_table(spark, pair):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a <|endoftext|>", "x"), (3, "a <|endoftext|>", "x"), (None, "b", None)], "doc_id bigint, text string, ids string")
    got = rows(encoding.encode(df))
    end = pair[1].encode_ordinary("a <|endoftext|>")
    assert got == sorted([(1, []), (2, []), (3, end), (3, end), (None, pair[1].encode_ordinary("b"))], key=repr)
    assert encoding.encode(df.limit(0)).count() == 0


@needs_vocabulary
def test_budget(spark, pair):
    n = lambda t: len(pair[1].encode_ordinary(t))
    docs = spark.createDataFrame([(1, "one text", "s", "en", None), (2, "one text", "s", "en", None), (3, None, "s", "en", None), (4, "другой", None, None, "t"), (5, "one text", "z", "en", "t")], "doc_id bigint, text string, source string, lang string, topic string")
    units = spark.createDataFrame(
        [("u1", "b", [("i", "one text"), ("j", None)]), ("u1", "b", [("i", "one text"), ("j", None)]), ("u2", "b", [("i", "two")]), ("u3", "c", []), ("u4", "e", None)],
        "unit_id string, doc_id string, text_nodes array<struct<inline_id: string, source_text: string>>",
    )
    costs = spark.createDataFrame([("r1", "b", 5), ("r2", "b", 7), ("r3", "b", None)], "run_id string, doc_id string, estimated_input_tokens bigint")
    got = {tuple(r)[:5]: tuple(r)[5:] for r in budget.token_budget(docs, units, costs).collect()}
    assert got == {
        ("slice", None, "s", "en", None): (3, 2, 2 * n("one text"), None),
        ("slice", None, None, None, "t"): (1, 1, n("другой"), None),
        ("slice", None, "z", "en", "t"): (1, 1, n("one text"), None),
        ("rulebook", "b", None, None, None): (3, 3, n("one text") + n("two"), 7),
        ("rulebook", "c", None, None, None): (0, 0, 0, None),
        ("rulebook", "e", None, None, None): (0, 0, 0, None),
    }
    assert budget.token_budget(docs.limit(0), units.limit(0), costs.limit(0)).count() == 0
