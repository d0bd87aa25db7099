"""Operators that learn from a sample: languages, answers, alignment."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirespark.llm import alignment, language, ngrams, pairs

from .common import rows


@pytest.fixture(scope="module")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def chain(documents):
    return language.fit_chain(*ngrams.labelled_sample(documents))


TEXT = {
    "en": "Roll the storm die and add 13 before the lanterns go out. The leader may spend six supplies.", "ru": "Бросьте кубик бури и прибавьте шесть. Вожак может потратить припасы, даже если путь закрыт.",
    "de": "Wirf den Sturmwürfel und addiere sechs. Der Anführer darf Vorräte ausgeben aber nur einmal pro Kapitel.", "fr": "Lancez le dé de tempête et ajoutez deux. Chaque chasseur soigne cinq cicatrices comme indiqué au dos du livret.",
    "es": "Tira el dado de tormenta y suma nueve. El líder puede gastar suministros y guarda el resultado en secreto.", "uk": "Киньте кубик бурі та додайте шість. Ватажок може витратити припаси, навіть якщо шлях закрито.",
}


def test_samples_are_not_cut(spark):
    import inspect

    long = spark.range(300).selectExpr("id AS doc_id", "'en' AS lang", "repeat('roll the die ', 400) AS text")
    texts, _ = ngrams.labelled_sample(long)
    assert (len(texts), {len(t) for t in texts}) == (250, {3000})
    assert inspect.signature(language.fit_chain).parameters["steps"].default == 80


def test_rare_language_is_sampled_whole(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 10000 = 7, 'UK-ua', 'en ') AS lang", "if(id % 10000 = 7, 'Киньте кубик бурі та додайте шість', 'Roll the storm die and add six') AS text")
    texts, labels = ngrams.labelled_sample(docs)
    assert (labels.count("uk"), labels.count("en")) == (3, 250)
    assert ngrams.labelled_sample(docs.limit(0)) == ([], [])


def test_long_words_keep_their_features():
    word = "donau" * 20
    assert len(language.features(word)) == 7 + len(word) + (len(word) + 1)


def test_pieces_hold_rows_and_bytes():
    import pyarrow as pa

    from quirespark.llm.batches import pieces

    batch = pa.RecordBatch.from_arrays([pa.array(["a", None, "b" * 50, "", "c" * 9, "d"])], ["t"])
    assert [p.num_rows for p in pieces(batch, (0,), 3, 10)] == [2, 1, 3]
    assert [p.num_rows for p in pieces(batch, (0,), 2)] == [2, 2, 2]
    assert list(pieces(batch.slice(0, 0), (0,))) == []


def test_segments_within_a_line(spark, chain):
    line = "Roll the storm die and add six supplies before the lanterns go out and Der Anführer darf Vorräte ausgeben aber nur einmal pro Kapitel then pass the torch to the left"
    docs = spark.createDataFrame([(1, TEXT["en"] * 3 + "\n" + line), (2, None), (3, ""), (4, TEXT["ru"])], "doc_id bigint, text string")
    (got,) = language.segments(docs, chain).collect()
    assert (got["doc_id"], got["line_no"], got["lang"]) == (1, 2, "de") and abs(got["from_word"] - 15) <= 1 and abs(got["to_word"] - 24) <= 1
    assert language.segments(docs.limit(0).selectExpr("*", "'en' AS lang")).count() == 0


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    like, step = rng.random((4, 1, 3)).astype(np.float32), rng.random((3, 3)).astype(np.float32)
    post = language.forward_backward(like, step, np.array([4]))
    post /= post.sum(axis=2, keepdims=True)
    want = np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        p = np.prod([like[t, 0, s] for t, s in enumerate(path)]) * np.prod([step[a, b] for a, b in zip(path, path[1:])])
        for t, s in enumerate(path):
            want[t, s] += p
    assert np.allclose(post[:, 0], want / want.sum(axis=1, keepdims=True), atol=1e-4)


def test_padding_changes_nothing(chain):
    texts = [TEXT["en"], TEXT["en"] + "\n" + TEXT["ru"] * 5]
    one = language.label_batch(chain, texts[:1])
    two = language.label_batch(chain, texts)
    assert one[0][0] == two[0][0] and abs(one[1][0] - two[1][0]) < 1e-3


@pytest.mark.parametrize("lang", TEXT)
def test_held_out_languages(chain, lang):
    main, share, foreign = language.label_batch(chain, [TEXT[lang]])
    assert chain.labels[main[0]] == lang and share[0] > 0.5 and not foreign


def test_documents(spark, chain):
    mixed = "\n".join([TEXT["ru"], "", TEXT["ru"], TEXT["de"], "Ashmö Warden", "Dungul Mask 12"])
    docs = spark.createDataFrame([(1, mixed, "RU "), (2, TEXT["en"], "bg"), (3, TEXT["en"], None), (4, None, None), (5, "", "en"), (6, "12 — 3", None), (7, TEXT["fr"] * 400, "fr-FR"), (7, TEXT["fr"] * 400, "fr-FR")], "doc_id bigint, text string, lang string").selectExpr("*", "0 AS line_no", "1.0 AS confidence")
    got = rows(language.languages(docs, chain), "doc_id", "line_no", "lang", "label")
    assert got == sorted([(1, 0, "ru", "ru"), (1, 4, "de", "ru"), (2, 0, "en", "bg"), (3, 0, "en", None), (7, 0, "fr", "fr"), (7, 0, "fr", "fr")], key=repr)
    assert language.languages(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def judge(spark, data, documents):
    u, a = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("translation_units", "translated_nodes"))
    return pairs.fit_judge(pairs.pairs(u, a), documents)


EN = "Roll the storm die and add 6. The leader may spend 4 supplies before the lanterns go out."
RU = "Бросьте кубик бури и прибавьте 6. Вожак может потратить припасы (4), прежде чем погаснут огни."


@pytest.mark.parametrize(
    "source,answer,want",
    [
        (EN, RU, None), (EN, None, "empty"), (EN, " ​ ", "empty"), (EN, "—", "empty"), (EN, "n/a", "empty"), (EN, "<ru_text/>", "empty"), (EN, EN.upper(), "copy"), (EN, "[RU] " + EN, "copy"), (EN, TEXT["de"], "language"), (EN, TEXT["uk"], "language"),
        (EN, "Извините, я не могу перевести этот фрагмент.", "refusal"), (EN, "As an assistant I must decline this request.", "refusal"), (EN, RU[:50], "truncated"), (EN, "Бросьте кубик бури и прибавьте 6.", "truncated"), (EN, RU[:60] + "…", "truncated"),
        ("[3]", "[3]", None), ("[3]", None, "empty"), ("{flame} ×2", "{flame} ×2", None), ("“I am sorry, traveller, I cannot help you,” says the Mask.", "«Прости, странник, я не могу тебе помочь», — говорит Лик Содор.", None),
    ],
)
def test_defects(judge, source, answer, want):
    assert judge.defects([source], [answer]) == [want]


def test_ends_by_brute_force():
    answers = ["Вожак идёт.", "Вожак ид", "Ход окончен. ", "ха", "", "Да."]
    ends = pairs.Ends.of(["a."] * len(answers), answers)
    texts = [a.rstrip() for a in answers]
    for answer, got in zip(answers, ends.likelihoods(answers)):
        t = answer.rstrip()
        p = sum(map(bool, texts)) / sum(map(len, texts))
        for n in range(1, min(4, len(t)) + 1):
            gram = t[-n:]
            seen = sum(x[i : i + n] == gram for x in texts for i in range(len(x) - n + 1)) - 1
            p = (sum(x.endswith(gram) and len(x) >= n for x in texts) - 1 + 8 * p) / (seen + 8)
        assert abs(p - got) < 1e-9


def test_prompt_in_the_language_of_the_answer(judge):
    """What a response is expected in depends on its prompt, what is asked for does not."""
    assert judge.foreign([EN, TEXT["ru"], EN, TEXT["ru"]], [TEXT["fr"], TEXT["de"], RU, RU]) == [True, True, False, False]


def test_answers(spark, documents):
    units = spark.createDataFrame([("u", [("i", EN), ("j", None), ("k", EN)])] * 2, "unit_id string, text_nodes array<struct<inline_id: string, source_text: string>>")
    answers = spark.createDataFrame([("u", "i", 1, None), ("u", "i", 1, None), ("u", "i", 2, RU), ("u", "j", 1, None), ("x", "i", 1, ""), ("u", "k", 1, EN), (None, None, None, None)], "unit_id string, inline_id string, attempt int, ru_text string").selectExpr("*", "'c' AS source")
    assert rows(pairs.found(units, answers, documents)) == [("u", "i", 1, "empty"), ("u", "k", 1, "copy")]
    assert pairs.found(units.limit(0), answers.limit(0), documents.limit(0)).count() == 0


def test_sounds():
    for a, b in (("Ashdorvale", "Ашдорвале"), ("Ñarmirrü", "Ньярмиррю"), ("Çoél", "Соэл"), ("Keshzarras", "Кешзаррас"), ("Ithñarul", "Итньярул")):
        assert alignment.sound(a) == alignment.sound(b)


def test_longest_increasing():
    assert alignment.longest_increasing([(0, 3), (1, 0), (2, 1), (3, 2), (3, 4)]) in ([(1, 0), (2, 1), (3, 2)], [(1, 0), (2, 1), (3, 4)])
    assert alignment.longest_increasing([]) == []


def test_alignment(spark, data):
    import pickle

    inl, nav = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("inline_nodes", "navigation"))
    lex = spark.sparkContext.broadcast(pickle.dumps(alignment.learn(inl, nav)))
    en = ["Each hunter heals 9 scars. Draw 3 cards from the threat deck even if the path is blocked.", "Skip the camp step entirely.", "Roll the storm die and add 14."]
    ru = ["Бросьте кубик бури и прибавьте 14. Это правило уточнено в издании 48.", "Каждый охотник лечит шрамы (девять); возьмите карты из колоды угроз (3), даже если путь закрыт.", ""]
    t = [("d", 1, f"b{k}", k, f"i{k}", a, b) for k, (a, b) in enumerate(zip(en, ru))]
    df = spark.createDataFrame(t + t[:1] + [("d", 2, "b", 0, "z", None, None), ("d", None, "b", 0, "n", "Roll the storm die and add 14.", "Бросьте кубик бури и прибавьте 14.")], "doc_id string, page_number int, block_id string, node_ord int, inline_id string, text string, ru_text string").selectExpr("*", "1 AS rn", "2 AS part")
    assert rows(alignment.page_pairs(df, lex)) == sorted([("d", "i0", 1, "i1", 1), ("d", "i0", 2, "i1", 1), ("d", "i2", 1, "i0", 1), ("d", "n", 1, "n", 1)], key=repr)
    labels = spark.createDataFrame([("d", "a", 1, "Questions about the Zarsei Anvil", None), ("d", "b", 4, "The legend of the Grimar Beast", "Вопросы о карте «Молот Зарсей»"), ("d", "c", 7, None, "Легенда о карте «Портал Ешаш»")], "doc_id string, anchor_id string, page_number int, label_en string, label_ru string")
    assert rows(alignment.label_pairs(labels, lex)) == [("d", "a", 1, "b", 1)]
    assert alignment.found(df.limit(0), labels.limit(0)).count() == 0


def test_more_pairs_of_words_than_the_driver_takes(spark, data, monkeypatch):
    """Beyond MODEL_PAIRS no pair of words is left out: the same lexicon and the same rows."""
    inl, nav = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("inline_nodes", "navigation"))
    inl = inl.unionByName(inl.where("page_number = 1").withColumn("page_number", F.lit(None).cast(inl.schema["page_number"].dataType)))
    whole, want = alignment.learn(inl, nav), rows(alignment.found(inl, nav))
    monkeypatch.setattr(alignment, "MODEL_PAIRS", 50)
    table = alignment.learn(inl, nav)
    lex = alignment.Lexicon({}, {}, {}, table.kinds)
    lex.add([r.asDict() for r in table.words.collect()])
    assert (lex.kinds, lex.weight_en, lex.weight_ru) == (whole.kinds, whole.weight_en, whole.weight_ru)
    assert {e: {f: pytest.approx(t) for f, t in fs.items()} for e, fs in lex.gives.items()} == whole.gives
    assert want and rows(alignment.found(inl, nav)) == want


def page_of(spark, rows):
    return spark.createDataFrame([("d", 1, f"b{k:04d}", 0, f"i{k:04d}", a, b) for k, (a, b) in enumerate(rows)], "doc_id string, page_number int, block_id string, node_ord int, inline_id string, text string, ru_text string")


@pytest.mark.parametrize("n", [100, 2000])
def test_long_page_with_far_moved_sentences(n):
    """A page, of 2,000 rows too, a fifth of them moved anywhere: each pair once, by either way of summing up."""
    rng = np.random.default_rng(3)
    place = np.arange(n)
    moved = rng.choice(n, n // 5, replace=False)
    place[moved] = place[rng.permutation(moved)]
    made = [(f"Item {k} of the Torvale{k} list.", f"Предмет {int(p)} из «Torvale{int(p)}».") for k, p in enumerate(place)]
    lex = alignment.Lexicon.of_rows([("Item 1 of the list.", "Предмет 1 из списка.")] * 30)
    en = [alignment.Sentence(f"i{k:04d}", 1, a, True, lex.kinds) for k, (a, _) in enumerate(made)]
    ru = [alignment.Sentence(f"i{k:04d}", 1, b, False, lex.kinds) for k, (_, b) in enumerate(made)]
    got = alignment.Book(lex).align([alignment.Page(lex, en, ru)])[0]
    want = sorted((int(p), k) for k, p in enumerate(place))
    assert len(set(got) & set(want)) >= 0.99 * n and len(got) <= 1.01 * n


def test_both_ways_of_finding_pairs_agree(spark, data):
    inl, nav = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("inline_nodes", "navigation"))
    lex = alignment.learn(inl, nav)
    pages: dict = {}
    for r in inl.where("text <> '' or ru_text <> ''").distinct().orderBy("doc_id", "page_number", "block_id", "node_ord").collect():
        pages.setdefault((r["doc_id"], r["page_number"]), []).append(r)
    made = []
    for rs in pages.values():
        en = [alignment.Sentence(r["inline_id"], k, s, True, lex.kinds) for r in rs for k, s in enumerate(alignment.sentences(r["text"]), 1)]
        ru = [alignment.Sentence(r["inline_id"], k, s, False, lex.kinds) for r in rs for k, s in enumerate(alignment.sentences(r["ru_text"]), 1)]
        if en and ru:
            made.append(alignment.Page(lex, en, ru))
    assert alignment.Book(lex).near(made) == [alignment.Page(lex, p.en, p.ru).near() for p in made]


def test_heaviest_increasing():
    assert alignment.heaviest_increasing([(0, 2, 0.9), (1, 0, 0.5), (2, 1, 0.5), (2, 3, 0.2)]) == [(0, 2), (2, 3)]
    assert alignment.heaviest_increasing([]) == []


def test_learn_without_rows():
    lex = alignment.Lexicon.of_rows([])
    s = [alignment.Sentence("a", 1, "Draw 3 cards", True, lex.kinds)], [alignment.Sentence("b", 1, "Возьмите 3", False, lex.kinds)]
    assert alignment.Page(lex, *s).align() in ([], [(0, 0)])
