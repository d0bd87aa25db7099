"""From primitives to blocks: headings, lists, captions and paragraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.ids import block_id

BODY_SIZE = 11.0
PAGE = ("doc_id", "page_number")


def first_seen_mode(df: DataFrame, keys: list[str], value: str, *order: str, weight=None, name: str | None = None) -> DataFrame:
    """Most frequent value of each group (by ``weight``); of equals the one seen first."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight if weight is not None else F.lit(1)).alias("__n"), F.min(F.struct(*order)).alias("__first"))
    # max_by cannot rank a struct downwards, so the earliest of the largest is taken by min.
    top = counted.groupBy(*keys).agg(F.max("__n").alias("__n"))
    return counted.join(top, [*keys, "__n"]).groupBy(*keys).agg(F.min_by(value, "__first").alias(name or value))


def body_sizes(texts: DataFrame) -> DataFrame:
    """``doc_id, body_size``: the commonest font size of each document."""
    return first_seen_mode(texts, ["doc_id"], "font_size", "page_number", "prim_ord", "primitive_id", name="body_size")


def classify(texts: DataFrame, ratio: float = 1.15) -> DataFrame:
    """Adds ``clean`` and ``kind_hint``: skip, list_item, heading, caption or paragraph.

    Empty texts, page headers and noise are skipped.
    """
    body = body_sizes(texts)
    clean = t.squeeze(t.undecorate(t.plain_letters(F.coalesce("text", F.lit("")))))
    joined = texts.join(body, "doc_id", "left").withColumn("body_size", F.coalesce("body_size", F.lit(BODY_SIZE)))

    def kind(c):
        return (
            F.when(t.is_page_header(c) | t.is_noise(c), "skip")
            .when(t.bullet(c) != "", "list_item")
            .when(t.is_heading(c, F.coalesce("font_size", F.lit(0.0)), F.col("body_size"), ratio), "heading")
            .when(t.is_caption(c), "caption")
            .otherwise("paragraph")
        )

    both = t.let(clean, lambda c: F.struct(c.alias("clean"), kind(c).alias("kind_hint")))
    # A generator keeps filters on the kind from being pushed below it, where they would evaluate all of this again.
    return joined.select("*", F.explode(F.array(both)).alias("__both")).select(*joined.columns, "__both.clean", "__both.kind_hint")


def list_runs(classified: DataFrame, anchored: bool = False) -> DataFrame:
    """Consecutive list items of a page as one list: ``doc_id, page_number, first_ord, items``.

    Skipped texts do not break a run, any other text does.  ``anchored`` adds the
    ``primitive_id`` of the first item.
    """
    kept = classified.where(F.col("kind_hint") != "skip")
    w = Window.partitionBy(*PAGE).orderBy("prim_ord", "primitive_id")
    item = F.col("kind_hint") == "list_item"
    start = F.when(item & ~F.coalesce(F.lag("kind_hint").over(w) == "list_item", F.lit(False)), 1).otherwise(0)
    runs = kept.withColumn("__start", start).withColumn("run", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("kind_hint") == "list_item")
    items = F.array_sort(F.collect_list(F.struct("prim_ord", "primitive_id", t.without_bullet(F.col("clean")).alias("text"))))
    first = [F.min_by("primitive_id", F.struct("prim_ord", "primitive_id")).alias("primitive_id")] if anchored else []
    return runs.groupBy(*PAGE, "run").agg(F.min("prim_ord").alias("first_ord"), items.alias("items"), *first).drop("run").withColumn("items", F.transform("items", lambda x: x["text"]))


def blocks(classified: DataFrame, anchored: bool = False) -> DataFrame:
    """Blocks of each page in order: ``doc_id, page_number, block_ord, block_id, kind, level, content``.

    A list is one block with its items joined by line breaks; headings from half
    as large again as the body are of level 1.  ``anchored`` adds the ``primitive_id``
    of the text that a block stands for, of a list its first item.
    """
    more = ["primitive_id"] if anchored else []
    lists = list_runs(classified, anchored).select(*PAGE, *more, F.col("first_ord").alias("ord"), F.lit("list").alias("kind"), F.lit(None).cast("int").alias("level"), F.array_join("items", "\n").alias("content"))
    level = F.when(F.col("kind_hint") == "heading", F.when(F.col("font_size") >= 1.5 * F.col("body_size"), 1).otherwise(2))
    rest = classified.where(F.col("kind_hint").isin("heading", "caption", "paragraph")).select(*PAGE, *more, F.col("prim_ord").alias("ord"), F.col("kind_hint").alias("kind"), level.alias("level"), F.col("clean").alias("content"))
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy("ord", "kind", "content")) - 1
    both = lists.unionByName(rest).withColumn("block_ord", n)
    return both.withColumn("block_id", block_id(F.col("doc_id"), F.col("page_number"), F.col("block_ord"), F.col("kind"))).drop("ord")


def merge_paragraphs(page_blocks: DataFrame) -> DataFrame:
    """Paragraphs that go on in the next one become one: ``doc_id, page_number, block_ord, content``.

    Whether a text goes on is asked of all that was joined so far, so this is a
    fold over the ordered paragraphs of a page, done inside generated code; other
    blocks keep paragraphs apart.
    """
    w = Window.partitionBy(*PAGE).orderBy("block_ord")
    other = F.when(F.col("kind") != "paragraph", 1).otherwise(0)
    runs = page_blocks.withColumn("__run", F.sum(other).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("kind") == "paragraph")
    grouped = runs.groupBy(*PAGE, "__run").agg(F.array_sort(F.collect_list(F.struct("block_ord", "content"))).alias("ps"))
    kind = "array<struct<block_ord: int, content: string>>"
    last = lambda acc: F.element_at(acc, -1)

    def step(acc, x):
        joined = F.struct(last(acc)["block_ord"].alias("block_ord"), F.concat_ws(" ", last(acc)["content"], x["content"]).alias("content"))
        own = F.struct(x["block_ord"].alias("block_ord"), x["content"].alias("content"))
        return F.when((F.size(acc) > 0) & F.coalesce(t.continues(F.try_element_at(acc, F.lit(-1))["content"]), F.lit(False)), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(own))).cast(kind)

    folded = grouped.withColumn("ps", F.aggregate("ps", F.array().cast(kind), step))
    return folded.select(*PAGE, F.explode("ps").alias("p")).select(*PAGE, F.col("p.block_ord").alias("block_ord"), F.col("p.content").alias("content"))


def merge_runs(spans: DataFrame) -> DataFrame:
    """Neighbouring spans of one style joined without a blank: needs ``block_id, span_ord, text, font_name, font_size, is_bold, is_italic``."""
    key = F.struct(t.font_family(F.coalesce("font_name", F.lit(""))).alias("f"), F.coalesce("is_bold", F.lit(False)).alias("b"), F.coalesce("is_italic", F.lit(False)).alias("i"))
    w = Window.partitionBy("block_id").orderBy("span_ord")
    keyed = spans.withColumn("__key", key)
    fresh = F.when(F.lag("__key").over(w) == F.col("__key"), 0).otherwise(1)
    runs = keyed.withColumn("__new", fresh).withColumn("run_ord", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span_ord", "text"))), lambda x: x["text"]), "")
    return runs.groupBy("block_id", "run_ord", "__key").agg(joined.alias("text"), F.max("font_size").alias("font_size")).select("block_id", "run_ord", "text", "font_size", F.col("__key.f").alias("font_family"), F.col("__key.b").alias("is_bold"), F.col("__key.i").alias("is_italic"))


def join_lines(lines):
    """Lines of a block as one text.

    Each line is brought to its plain form first, blank ones are left out.  What a
    line repeats of the end of the last kept line (more than two characters) is
    dropped and its rest, after a blank, belongs to that line.
    """
    clean = F.filter(F.transform(lines, lambda x: t.squeeze(t.undecorate(t.plain_letters(x)))), lambda x: x != "")
    kind = "struct<done: array<string>, last: string>"

    def glue(acc, x, tail):
        # The end of the last line is cut off once a line, not once a candidate length.
        sizes = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(tail), F.length(x)))), lambda k: F.right(tail, k) == F.left(x, k))

        def put(k):
            rest = F.ltrim(F.substring(x, k + 1, F.length(x)))
            same = F.when(rest == "", acc["last"]).otherwise(F.concat_ws(" ", acc["last"], rest))
            own = F.struct(F.concat(acc["done"], F.array(acc["last"])).alias("done"), x.alias("last")).cast(kind)
            return F.when(k > 2, F.struct(acc["done"].alias("done"), same.alias("last")).cast(kind)).otherwise(own)

        return t.let(F.coalesce(F.array_max(sizes), F.lit(0)), put)

    def step(acc, x):
        first = F.struct(acc["done"].alias("done"), x.alias("last")).cast(kind)
        return F.when(acc["last"].isNull(), first).otherwise(t.let(F.right(acc["last"], F.length(x)), lambda tail: glue(acc, x, tail)))

    start = F.struct(F.array().alias("done"), F.lit(None).alias("last")).cast(kind)
    whole = F.aggregate(clean, start, step, lambda acc: F.concat_ws(" ", acc["done"], acc["last"]))
    return t.squeeze(t.undecorate(whole))


#: Words of the longest phrase whose repeat is dropped.
PHRASE_WORDS = 4


def without_repeats(text):
    """Immediate repeats of one to four words are dropped in one pass from the left, the longest at each place.

    A text of fewer than two words stays as it is; in others white space becomes
    single blanks.
    """

    def of(words):
        def longest(k):
            out = F.lit(0)
            for n in range(1, PHRASE_WORDS + 1):
                # The first words decide in nearly all places.
                same = (F.get(words, k - 1) == F.get(words, k - 1 + n)) & (F.slice(words, k, n) == F.slice(words, k + n, n))
                out = F.when(same, n).otherwise(out)
            return F.struct(k.alias("k"), out.alias("n"))

        found = F.filter(F.transform(F.sequence(F.lit(1), F.size(words)), longest), lambda x: x["n"] > 0)
        kind = "struct<next: int, cuts: array<struct<k: int, n: int>>>"

        def take(s, x):
            return F.when(x["k"] >= s["next"], F.struct((x["k"] + 2 * x["n"]).alias("next"), F.concat(s["cuts"], F.array(x)).alias("cuts")).cast(kind)).otherwise(s)

        cuts = F.aggregate(found, F.struct(F.lit(1).alias("next"), F.array().alias("cuts")).cast(kind), take, lambda s: s["cuts"])

        def kept(cuts):
            begin = lambda i: F.when(i == 0, 1).otherwise(F.get(cuts, i - 1)["k"] + 2 * F.get(cuts, i - 1)["n"])
            parts = F.transform(cuts, lambda c, i: F.slice(words, begin(i), c["k"] + c["n"] - begin(i)))
            return F.concat(F.flatten(parts), F.slice(words, begin(F.size(cuts)), F.size(words)))

        return F.when(F.size(words) < 2, text).otherwise(F.array_join(t.let(cuts, kept), " "))

    return t.let(F.filter(F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != ""), of)


def callout_members(page_boxes: DataFrame, callouts: DataFrame) -> DataFrame:
    """Blocks whose centre lies in a callout of their page: an equi-join by page with a range condition."""
    from ..functions import geometry as g

    c = callouts.select(*[F.col(x).alias("c_" + x) for x in (*PAGE, "region_id", "x0", "y0", "x1", "y1")])
    on = (F.col("doc_id") == F.col("c_doc_id")) & (F.col("page_number") == F.col("c_page_number")) & g.centre_inside(g.box("c_"), g.box())
    return page_boxes.join(c, on).select(*PAGE, F.col("primitive_id"), F.col("c_region_id").alias("region_id"))


def wrap_callouts(page_blocks: DataFrame, members: DataFrame) -> DataFrame:
    """Member blocks of a callout become one block of kind ``callout`` where the first of them stood.

    ``members(doc_id, page_number, block_id, region_id)``; a block in several
    callouts goes to the first by name.  List items stay lines of their own.
    """
    once = members.groupBy(*PAGE, "block_id").agg(F.min("region_id").alias("region_id"))
    inside = page_blocks.join(once, [*PAGE, "block_id"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_ord", "content"))), lambda x: x["content"]), "\n")
    calls = inside.groupBy(*PAGE, "region_id").agg(F.min("block_ord").alias("block_ord"), text.alias("content")).select(*PAGE, "block_ord", F.col("region_id").alias("block_id"), F.lit("callout").alias("kind"), F.lit(None).cast("int").alias("level"), "content")
    rest = page_blocks.join(once.select(*PAGE, "block_id"), [*PAGE, "block_id"], "left_anti").select(*PAGE, "block_ord", "block_id", "kind", "level", "content")
    return rest.unionByName(calls).withColumn("block_ord", F.row_number().over(Window.partitionBy(*PAGE).orderBy("block_ord", "block_id")) - 1)


def split_symbols(runs: DataFrame, tokens: list[tuple[str, str]], text: str = "text") -> DataFrame:
    """Adds ``parts``, an array of ``kind, value``: text between the first occurrences of the tokens of a pack, taken in its order.

    A token is looked for in what is left after the token before it; ``value`` of a symbol is its id.
    """
    part = "array<struct<kind: string, value: string>>"
    state = F.struct(F.array().cast(part).alias("done"), F.coalesce(F.col(text), F.lit("")).alias("left"))

    def cut(symbol: str, token: str):
        def step(s):
            at = F.instr(s["left"], F.lit(token))
            before = F.substring(s["left"], F.lit(1), at - 1)
            own = F.array(F.struct(F.lit("symbol").alias("kind"), F.lit(symbol).alias("value")))
            lead = F.when(before == "", F.array().cast(part)).otherwise(F.array(F.struct(F.lit("text").alias("kind"), before.alias("value"))))
            hit = F.struct(F.concat(s["done"], lead, own).cast(part).alias("done"), F.substring(s["left"], at + len(token), F.length(s["left"])).alias("left"))
            return F.when(at > 0, hit).otherwise(s)

        return step

    for symbol, token in tokens:
        if token:
            state = t.let(state, cut(symbol, token))
    done = t.let(state, lambda s: F.when(s["left"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(F.struct(F.lit("text").alias("kind"), s["left"].alias("value"))).cast(part))))
    return runs.withColumn("parts", done)


def apply_patches(page_blocks: DataFrame, patches: DataFrame) -> DataFrame:
    """Overrides of a pack, the last one wins for each block and target.

    ``patches(patch_ord, target_page, target_block_id, action, value)`` is a small
    pack; actions are ``override_block_kind`` (heading, paragraph)
    and ``replace_text``; a NULL page stands for all, unknown actions are ignored.
    """
    p = patches
    hit = page_blocks.join(p, (F.col("block_id") == F.col("target_block_id")) & (F.col("target_page").isNull() | (F.col("target_page") == F.col("page_number"))), "left")
    pick = lambda action, ok: F.max_by(F.when((F.col("action") == action) & ok, F.col("value")), F.when((F.col("action") == action) & ok, F.col("patch_ord")))
    cols = [c for c in page_blocks.columns]
    out = hit.groupBy(*cols).agg(pick("override_block_kind", F.col("value").isin("heading", "paragraph")).alias("__kind"), pick("replace_text", F.lit(True)).alias("__text"))
    return out.withColumns({"kind": F.coalesce("__kind", "kind"), "level": F.when(F.col("__kind") == "heading", 1).when(F.col("__kind").isNotNull(), None).otherwise(F.col("level")), "content": F.coalesce("__text", "content")}).drop("__kind", "__text")


def page_routes(pages: DataFrame, patches: DataFrame) -> DataFrame:
    """Pages with the ``route`` that the last ``set_render_mode`` or ``force_fallback`` of a pack gives them; unknown modes are ``semantic``."""
    mode = F.when(F.col("action") == "force_fallback", "facsimile").when(F.col("value").isin("hybrid", "facsimile"), F.col("value")).otherwise("semantic")
    p = patches.where(F.col("action").isin("set_render_mode", "force_fallback")).select("patch_ord", "target_page", mode.alias("__mode"))
    hit = pages.join(p, F.col("target_page").isNull() | (F.col("target_page") == F.col("page_number")), "left")
    return hit.groupBy(*pages.columns).agg(F.max_by("__mode", "patch_ord").alias("__mode")).withColumn("route", F.coalesce("__mode", "route")).drop("__mode")


def page_blocks(content: DataFrame, found: DataFrame, patches: DataFrame) -> DataFrame:
    """Blocks of each page as a reader gets them: figures, tables, then texts.

    ``doc_id, page_number, block_ord, block_id, kind, level, content, asset_ref``.
    Overlapping lines of a text are joined, unfinished paragraphs merged, repeated
    phrases of headings dropped, the blocks of a callout of ``found`` wrapped, and
    ``patches`` applied last.  A merged paragraph has the place of its last part.
    """
    texts = content.where(F.col("kind") == "text")
    own = blocks(classify(texts.withColumn("text", join_lines(F.split(t.compose("text"), r"\r?\n", -1)))), anchored=True)
    merged = merge_paragraphs(own).withColumnRenamed("content", "__merged")
    left = own.join(merged, [*PAGE, "block_ord"], "left").where((F.col("kind") != "paragraph") | F.col("__merged").isNotNull())
    again = t.squeeze(t.undecorate(t.plain_letters(F.col("__merged"))))
    left = left.withColumn("content", F.when(F.col("kind") == "heading", without_repeats(F.col("content"))).when(F.col("kind") == "paragraph", again).otherwise(F.col("content"))).drop("__merged")
    boxes = left.select(*PAGE, "block_id", "primitive_id").join(texts.select(*PAGE, "primitive_id", "x0", "y0", "x1", "y1"), [*PAGE, "primitive_id"])
    members = callout_members(boxes, found.where(F.col("kind_hint") == "callout")).join(left.select(*PAGE, "block_id", "primitive_id"), [*PAGE, "primitive_id"])
    wrapped = wrap_callouts(left, members.select(*PAGE, "block_id", "region_id"))
    # A region's name is that of a page; a block's is that of all documents.
    wrapped = wrapped.withColumn("block_id", F.when(F.col("kind") == "callout", block_id(F.col("doc_id"), F.col("page_number"), F.col("block_ord"), F.lit("callout"))).otherwise(F.col("block_id")))
    none = F.lit(None)
    image = F.col("kind") == "image"
    number = F.when(image, 900 + F.col("prim_ord")).otherwise(800 + F.col("prim_ord"))
    kind = F.when(image, "figure").otherwise("table")
    pictures = content.where(F.col("kind").isin("image", "table")).select(
        *PAGE, F.when(image, 0).otherwise(1).alias("__rank"), F.col("prim_ord").alias("block_ord"), block_id(F.col("doc_id"), F.col("page_number"), number, kind).alias("block_id"), kind.alias("kind"),
        none.cast("int").alias("level"), none.cast("string").alias("content"), F.when(image, F.substring("content_hash", 1, 16)).alias("asset_ref"),
    )
    every = wrapped.withColumns({"__rank": F.lit(2), "asset_ref": none.cast("string")}).unionByName(pictures)
    n = (F.row_number().over(Window.partitionBy(*PAGE).orderBy("__rank", "block_ord", "block_id")) - 1).alias("block_ord")
    return apply_patches(every.select(*PAGE, n, "block_id", "kind", "level", "content", "asset_ref"), patches)
