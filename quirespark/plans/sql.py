"""Fragments of SQL that the checks share."""

SPACE = r"[\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
DINGBAT = r"[\x{2500}-\x{27BF}\x{2B50}-\x{2B5F}\x{E000}-\x{F8FF}]"


def squeeze(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '{SPACE}', ' ', 'g'), '^ | $', '', 'g')"


def plain(c: str) -> str:
    return f"replace(replace(translate({c}, '“”‘’­', '\"\"'''''), 'ﬁ', 'fi'), 'ﬂ', 'fl')"


def undecorate(c: str) -> str:
    return f"CASE WHEN contains({c}, '{{') AND contains({c}, '}}') THEN translate({c}, '{{}}*', '   ') ELSE {c} END"


def noise(c: str) -> str:
    t = squeeze(f"coalesce({c}, '')")
    return (
        f"(length({t}) <= 2 OR regexp_matches({t}, '^\\d+$') OR regexp_matches({t}, '^[A-Z]{{2}}\\d{{4}}$') OR regexp_matches({t}, '^(?:[A-Za-z]+\\d+){{3,}}$') OR regexp_matches({t}, '^[IVXivx]{{8,}}$')"
        f" OR (length({t}) >= 4 AND (length(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) < 0.5 * length({t}) OR replace(lower({t}), left(lower({t}), 1), '') = '')))"
    )


def label(c: str) -> str:
    t = squeeze(f"coalesce({c}, '')")
    words = f"string_split({t}, ' ')"
    alpha = f"list_filter(list_transform({words}, lambda x: trim(x, ',.;:!?')), lambda x: regexp_matches(x, '^\\p{{L}}'))"
    capital = f"len(list_filter({alpha}, lambda x: NOT regexp_matches(x, '^\\p{{Lu}}'))) = 0"
    return f"(regexp_matches({t}, '^\\p{{L}}') AND len({words}) <= 6 AND ((regexp_matches({t}, '\\p{{L}}') AND upper({t}) = {t}) OR ({capital} AND (len({words}) = 1 OR len({alpha}) >= 2))))"


def goes_on(c: str) -> str:
    t = squeeze(f"coalesce({c}, '')")
    return f"({t} = '' OR (NOT {label(c)} AND (length({t}) < 10 OR right({t}, 1) = '-' OR regexp_matches({t}, '^\\p{{Ll}}') OR NOT contains('.!?:;)\"''', right({t}, 1)))))"


#: Text primitives, repeated rows once.
PRIMS = """p AS (SELECT DISTINCT doc_id, page_number, primitive_id, text, line_count, font_name, font_size, is_bold, is_italic, bbox_norm.x0 AS x0, bbox_norm.y0 AS y0, bbox_norm.x1 AS x1, bbox_norm.y1 AS y1,
 CAST(string_split(primitive_id, ':')[-1] AS INT) AS prim_ord FROM text_primitives)"""

#: Headings of the navigation and texts of the runs as ordered blocks of pages.
BLOCKS = """runs AS (SELECT DISTINCT doc_id, page_number, block_id, node_ord, inline_id, text FROM inline_nodes WHERE kind = 'text'),
nav AS (SELECT DISTINCT doc_id, page_number, anchor_id, nav_level, label_en FROM navigation),
raw AS (SELECT doc_id, page_number, anchor_id AS block_id, 'heading' AS kind, nav_level AS level, label_en AS content, 0 AS src, anchor_id AS k1, 0 AS k2 FROM nav
 UNION ALL SELECT doc_id, page_number, inline_id, 'paragraph', NULL, text, 1, block_id, node_ord FROM runs),
pb AS (SELECT doc_id, page_number, block_id, kind, level, content, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY src, k1, k2, block_id) - 1 AS INT) AS block_ord FROM raw)"""

#: Furniture of the text primitives at a rate of a tenth, on a grid of half a page.
FURNITURE = PRIMS + """, keyed AS (SELECT *, concat_ws('|', 'text', concat_ws(',', CAST(CAST(round_even(x0 / 0.5, 0) AS INT) AS VARCHAR), CAST(CAST(round_even(y0 / 0.5, 0) AS INT) AS VARCHAR), CAST(CAST(round_even(x1 / 0.5, 0) AS INT) AS VARCHAR), CAST(CAST(round_even(y1 / 0.5, 0) AS INT) AS VARCHAR)),
 concat_ws('@', coalesce(font_name, ''), CAST(CAST(round_even(coalesce(font_size, 0) * 10, 0) AS INT) AS VARCHAR)),
 CASE WHEN regexp_matches(trim(text), '^\\s*(?:\\d{1,4}|[ivxlcdm]{1,8}|[IVXLCDM]{1,8})\\s*$') THEN '#' ELSE substr(sha256(trim(coalesce(text, ''))), 1, 12) END) AS key FROM p),
tot AS (SELECT doc_id, count(DISTINCT page_number) AS total FROM p GROUP BY doc_id),
cl AS (SELECT doc_id, key, count(DISTINCT page_number) AS pc, median(x0) AS x0, median(y0) AS y0, median(x1) AS x1, median(y1) AS y1, list_sort(list(DISTINCT page_number)) AS pages,
 arg_min(substr(text, 1, 80), {'a': page_number, 'b': prim_ord, 'c': primitive_id}) AS text_sample, min({'a': page_number, 'b': prim_ord, 'c': primitive_id}) AS first FROM keyed GROUP BY doc_id, key),
fr AS (SELECT cl.*, tot.total, coalesce(regexp_matches(text_sample, '^\\s*(?:\\d{1,4}|[ivxlcdm]{1,8}|[IVXLCDM]{1,8})\\s*$'), FALSE) AS num FROM cl JOIN tot USING (doc_id) WHERE total >= 2 AND pc >= 0.1 * total),
ft AS (SELECT *, CASE WHEN y1 > 0.92 AND num THEN 'page_number' WHEN y0 < 0.08 THEN 'header' WHEN y1 > 0.92 THEN 'footer' WHEN greatest(x1 - x0, 0) * greatest(y1 - y0, 0) > 0.3 THEN 'background_panel' ELSE 'ornament' END AS furniture_type
 FROM fr WHERE y0 < 0.08 OR y1 > 0.92 OR x0 < 0.08 OR x1 > 0.92 OR num),
furn AS (SELECT *, printf('furn:%s:%03d', furniture_type, row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1) AS candidate_id FROM ft)"""

#: Bands and columns of the pages.
BANDS = PRIMS + """, b0 AS (SELECT *, max(y1) OVER (PARTITION BY doc_id, page_number ORDER BY y0, prim_ord, primitive_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p),
b AS (SELECT *, CAST(sum(CASE WHEN y0 - reach >= 0.03 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_number ORDER BY y0, prim_ord, primitive_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS band_index FROM b0),
s0 AS (SELECT *, max(x1) OVER (PARTITION BY doc_id, page_number, band_index ORDER BY x0, x1, primitive_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS xr FROM b),
s1 AS (SELECT *, CAST(sum(CASE WHEN x0 <= xr THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page_number, band_index ORDER BY x0, x1, primitive_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) - 1 AS span FROM s0),
sp AS (SELECT doc_id, page_number, band_index, span, min(x0) AS s0, max(x1) AS s1 FROM s1 GROUP BY ALL),
gp AS (SELECT *, lead(s0) OVER (PARTITION BY doc_id, page_number, band_index ORDER BY span) AS nx FROM sp),
gu AS (SELECT doc_id, page_number, band_index, arg_max((s1 + nx) / 2, {'g': nx - s1, 's': -span}) AS gx, max(nx - s1) AS gap FROM gp WHERE nx IS NOT NULL GROUP BY ALL),
c AS (SELECT b.*, CASE WHEN gu.gx IS NULL THEN NULL WHEN (x0 + x1) / 2 < gu.gx THEN 0 ELSE 1 END AS column_index FROM b LEFT JOIN (SELECT * FROM gu WHERE gap >= 0.02) gu USING (doc_id, page_number, band_index))"""

REGIONS = BANDS + """, bb AS (SELECT doc_id, page_number, band_index, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, CAST(greatest(count(DISTINCT column_index), 1) AS INT) AS column_count FROM c GROUP BY ALL),
cc AS (SELECT doc_id, page_number, band_index, column_index, min(c.x0) AS x0, min(c.y0) AS y0, max(c.x1) AS x1, max(c.y1) AS y1 FROM c WHERE column_index IS NOT NULL GROUP BY ALL),
r0 AS (SELECT doc_id, page_number, band_index, 'band' AS kind_hint, CAST(NULL AS INT) AS column_index, x0, y0, x1, y1, column_count, 0.9 AS confidence, 0 AS rank, 0 AS ord FROM bb
 UNION ALL SELECT cc.doc_id, cc.page_number, cc.band_index, CASE WHEN bb.x1 > bb.x0 AND (cc.x1 - cc.x0) / (bb.x1 - bb.x0) < 0.35 THEN 'sidebar' ELSE 'column' END, cc.column_index, cc.x0, cc.y0, cc.x1, cc.y1, NULL,
 CASE WHEN bb.x1 > bb.x0 AND (cc.x1 - cc.x0) / (bb.x1 - bb.x0) < 0.35 THEN 0.7 ELSE 0.85 END, 1, cc.column_index FROM cc JOIN bb USING (doc_id, page_number, band_index)),
r1 AS (SELECT *, printf('reg:%d:%d', page_number, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY band_index, rank, ord, x0, y0) - 1) AS region_id FROM r0),
r AS (SELECT *, CASE WHEN rank > 0 THEN max(CASE WHEN rank = 0 THEN region_id END) OVER (PARTITION BY doc_id, page_number, band_index) END AS parent_region_id FROM r1)"""

ORDER = REGIONS + """, o0 AS (SELECT *, max(CASE WHEN kind_hint = 'column' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_number, band_index) AS has, max(column_count) OVER (PARTITION BY doc_id, page_number, band_index) AS cols FROM r),
o1 AS (SELECT * FROM o0 WHERE NOT (kind_hint = 'band' AND has = 1)),
o AS (SELECT doc_id, page_number, region_id, kind_hint, band_index, column_index, confidence,
 CASE WHEN kind_hint = 'sidebar' THEN 'aside' WHEN kind_hint = 'band' AND cols = 1
  AND EXISTS (SELECT 1 FROM bb WHERE bb.doc_id = o1.doc_id AND bb.page_number = o1.page_number AND bb.band_index < o1.band_index AND bb.column_count > 1)
  AND EXISTS (SELECT 1 FROM bb WHERE bb.doc_id = o1.doc_id AND bb.page_number = o1.page_number AND bb.band_index > o1.band_index AND bb.column_count > 1) THEN 'interruption' ELSE 'main' END AS flow_role,
 CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY band_index, CASE WHEN kind_hint IN ('band', 'column') THEN 0 ELSE 2 END, CASE WHEN kind_hint IN ('band', 'column') THEN coalesce(column_index, 0) ELSE y0 END, region_id) - 1 AS INT) AS sequence_index FROM o1)"""
