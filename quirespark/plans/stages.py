"""Stages as functions of tables, their selection, and a runner that reuses stored results.

A stage takes the tables of the run so far and returns a table.  Its result is
written under a key made of its own version, its settings and the keys of what it
reads, so that a changed input makes it run again and an unchanged one is read back.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from ..storage import exists

MODES = ("read_write", "read_only", "write_only", "off", "force_refresh")


@dataclass(frozen=True)
class Stage:
    """``run(tables) -> table``; ``needs`` names the tables that it reads."""

    name: str
    run: Callable[[Mapping[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    version: str = "1"
    settings: Mapping[str, object] = field(default_factory=dict)


class Registry:
    """Stages in their order; names are unique."""

    def __init__(self) -> None:
        self.stages: dict[str, Stage] = {}

    def register(self, stage: Stage) -> Stage:
        if stage.name in self.stages:
            raise ValueError(f"stage {stage.name} is registered already")
        self.stages[stage.name] = stage
        return stage

    def select(self, first: str | None = None, last: str | None = None, only: list[str] | None = None, exclude: list[str] | None = None) -> list[Stage]:
        """``only`` overrides the range, ``exclude`` comes last; unknown names are errors."""
        names = list(self.stages)
        for name in [*filter(None, (first, last)), *(only or ()), *(exclude or ())]:
            if name not in self.stages:
                raise ValueError(f"unknown stage {name}")
        if only:
            names = [n for n in names if n in only]
        else:
            names = names[names.index(first) if first else 0 : names.index(last) + 1 if last else None]
        return [self.stages[n] for n in names if n not in (exclude or ())]


@dataclass
class StageRun:
    stage: str
    status: str
    cache: str
    key: str
    started_at: datetime
    duration_ms: int
    error: str | None = None


class Runner:
    """Runs stages in order over a store of their results."""

    def __init__(self, spark: SparkSession, store: str, mode: str = "read_write") -> None:
        if mode not in MODES:
            raise ValueError(f"unknown cache mode {mode}")
        self.spark, self.store, self.mode = spark, store, mode
        self.log: list[StageRun] = []

    def key(self, stage: Stage, keys: Mapping[str, str]) -> str:
        parts = {"name": stage.name, "version": stage.version, "settings": dict(stage.settings), "needs": {n: keys.get(n, n) for n in stage.needs}}
        return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()

    def run(self, stages: list[Stage], inputs: Mapping[str, DataFrame], versions: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
        """Tables by name: the inputs and the result of each stage.  A failed stage is logged and raised.

        What depends on an input without a version is never read back: nothing tells whether it changed.
        """
        tables, keys = dict(inputs), {**{n: f"unknown:{uuid.uuid4()}" for n in inputs}, **(versions or {})}
        for stage in stages:
            began, at = time.time(), datetime.now(timezone.utc)
            key = keys[stage.name] = self.key(stage, keys)
            path = os.path.join(self.store, stage.name, key[:16])
            done = os.path.join(path, "_SUCCESS")
            reads, writes = self.mode in ("read_write", "read_only"), self.mode in ("read_write", "write_only", "force_refresh")
            try:
                if reads and exists(self.spark, done):
                    tables[stage.name], cache = self.spark.read.parquet(path), "hit"
                else:
                    missing = [n for n in stage.needs if n not in tables]
                    if missing:
                        raise KeyError(f"stage {stage.name} needs {', '.join(missing)}")
                    out, cache = stage.run(tables), "miss"
                    if writes:
                        out.write.mode("overwrite").parquet(path)
                        out = self.spark.read.parquet(path)
                    else:
                        # Without a store the plans of later stages would hold those of all earlier ones, many times over.
                        ensure_checkpoint_dir(self.spark)
                        out = out.checkpoint()
                    tables[stage.name] = out
            except Exception as e:
                self.log.append(StageRun(stage.name, "failed", "miss", key, at, int((time.time() - began) * 1000), str(e)[:500]))
                raise
            self.log.append(StageRun(stage.name, "completed", cache, key, at, int((time.time() - began) * 1000)))
        return tables

    def stage_runs(self) -> DataFrame:
        """The log as a table."""
        rows = [(r.stage, r.status, r.cache, r.key, r.started_at, r.duration_ms, r.error) for r in self.log]
        return self.spark.createDataFrame(rows, "stage string, status string, cache string, cache_key string, started_at timestamp, duration_ms int, error string")


#: Tables of a run that may be left out, with their columns.
OPTIONAL_INPUTS = {
    "patches": "patch_ord int, target_page int, target_block_id string, action string, value string",
    "symbols": "symbol_ord int, symbol_id string, token string, class_key string",
    "memory": "source_fingerprint string, translations array<string>",
    "titles": "doc_id string, title_en string, title_ru string",
    "catalog": "doc_id string, title_en string, title_ru string, page_count int",
}


def with_optional(spark: SparkSession, inputs: Mapping[str, DataFrame], versions: Mapping[str, str]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Inputs and versions with empty tables for those of a run that are left out."""
    from ..operators.primitives import OPTIONAL

    pictures = "doc_id string, page_number int, kind string, prim_ord int, primitive_id string, x0 double, y0 double, x1 double, y1 double, " + ", ".join(f"{c} {t}" for c, t in OPTIONAL.items())
    lacking = {n: s for n, s in {"pictures": pictures, **OPTIONAL_INPUTS}.items() if n not in inputs}
    return {**inputs, **{n: spark.createDataFrame([], s) for n, s in lacking.items()}}, {**versions, **{n: "none" for n in lacking}}


def document_stages() -> Registry:
    """The stages from primitives to releases, over ``texts``, ``terms`` and the tables of :func:`with_optional`.

    ``pictures`` are primitives that are no texts, ``symbols`` the tokens and classes
    of a pack.  Names of stages are those of their tables; the comments name the
    stages of the domain.
    """
    from pyspark.sql import functions as F

    from ..functions.ids import page_fingerprint, release_id
    from ..operators import assets, bundle, enrich, furniture, layout, links, primitives, quality, structure, translation

    reg = Registry()
    add = lambda name, needs, run, version="2": reg.register(Stage(name, run, needs, version))
    page = ["doc_id", "page_number"]
    kind = lambda t, *kinds: t["primitives"].where(F.col("kind").isin(*kinds))

    def candidates(t):
        tokens = t["symbols"].where(F.length("token") > 0).select("symbol_id", "token")
        hashes = t["symbols"].where(F.col("class_key").isNotNull()).select("symbol_id", "class_key")
        texts, hit = kind(t, "text"), assets.hash_matches
        found = assets.symbol_candidates(assets.token_matches(texts, tokens), hit(kind(t, "image"), hashes), hit(kind(t, "drawing"), hashes, "vector_signature"), assets.dingbats(texts))
        # How sure each detector is.
        sure = F.when(F.col("evidence_source") == "raster_hash", 0.99).when(F.col("evidence_source") == "text_token", 0.95).when(F.col("evidence_source") == "vector_signature", 0.9).otherwise(0.5)
        return found.withColumn("confidence", sure)

    def resolved(t):
        tokens = [(r["symbol_id"], r["token"]) for r in t["symbols"].where(F.length("token") > 0).orderBy("symbol_ord").collect()]
        linked = links.apply_links(t["blocks"], t["caption_links"])
        sure = t["symbol_candidates"].where("is_classified AND confidence >= 0.8 AND evidence_source <> 'text_token'")
        parts = structure.split_symbols(assets.tag_figures(linked, sure), tokens, "content")
        return parts.withColumn("parts", F.when(F.col("kind") != "list", F.col("parts")))

    def nodes(t):
        """Blocks of pages that are not shown as an image, as the rules of translation take them; lists are not looked at."""
        own = t["localized"].where(F.col("content").isNotNull() & (F.col("kind") != "list"))
        return own.select(*page, "block_id", "route", F.col("block_id").alias("inline_id"), F.col("content").alias("text"), "ru_text")

    def issues(t):
        refs = t["symbol_refs"].withColumnRenamed("block_id", "primitive_id")
        shown = quality.evaluate({"runs": nodes(t).where("route <> 'facsimile'")}, ["translation.missing"])
        rest = {"runs": nodes(t), "pages": t["pages"], "blocks": t["resolved"], "regions": t["regions"], "edges": t["edges"], "reading_order": t["reading_order"], "symbols": refs}
        return shown.unionByName(quality.evaluate(rest, [n for n in quality.RULES if n not in ("translation.missing", "entity.table_structure")]))

    def glossary(t):
        runs = t["localized"].where(F.col("content").isNotNull() & (F.col("kind") != "list"))
        return translation.glossary_links(runs.select(*page, "block_id", F.concat("block_id", F.lit(":i000")).alias("inline_id"), F.lit(0).alias("node_ord"), F.col("content").alias("text"), "ru_text"), t["terms"])

    def catalog(t):
        new = t["doc_summary"].select("doc_id", "page_count").join(t["titles"].dropDuplicates(["doc_id"]), "doc_id", "left")
        return bundle.upsert_catalog(t["catalog"].select("doc_id", "title_en", "title_ru", "page_count"), new)

    # extract_primitives, collect_evidence
    add("primitives", ("texts", "pictures"), lambda t: primitives.from_text_table(t["texts"]).unionByName(t["pictures"]))
    add("furniture", ("primitives",), lambda t: furniture.candidates(t["primitives"]))
    add("templates", ("furniture",), lambda t: furniture.templates(t["furniture"]))
    add("content", ("primitives", "furniture"), lambda t: furniture.mask(t["primitives"], t["furniture"]))
    add("assets", ("primitives", "furniture"), lambda t: assets.occurrences(t["primitives"], t["furniture"]))
    add("asset_classes", ("assets",), lambda t: assets.classes(t["assets"]))
    add("symbol_candidates", ("primitives", "symbols"), candidates)
    add("symbol_summary", ("symbol_candidates",), lambda t: assets.symbol_summary(t["symbol_candidates"]))
    add("regions", ("content",), lambda t: layout.regions(t["content"]))
    add("edges", ("regions",), lambda t: layout.edges(t["regions"]))
    add("reading_order", ("regions",), lambda t: layout.reading_order(t["regions"]))
    add("canonical", ("regions",), lambda t: layout.canonical_flags(t["regions"]))
    # resolve_page_ir
    add("confidence", ("regions", "reading_order", "furniture"), lambda t: layout.page_confidence(t["regions"], t["reading_order"], furniture.page_furniture(t["furniture"])))
    add("pages", ("confidence", "patches"), lambda t: structure.page_routes(t["confidence"].select(*page, "confidence", "route"), t["patches"]))
    # normalize_layout
    add("blocks", ("content", "regions", "patches"), lambda t: structure.page_blocks(t["content"], t["regions"], t["patches"]))
    add("fingerprints", ("blocks",), lambda t: t["blocks"].groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("block_ord", "content"))).alias("b")).select(*page, page_fingerprint(F.array_join("b.content", " "), F.col("page_number")).alias("fingerprint")))
    # resolve_assets_symbols
    add("caption_links", ("regions", "primitives", "blocks"), lambda t: links.figure_captions(t["regions"], kind(t, "text"), t["blocks"]))
    add("resolved", ("blocks", "caption_links", "symbol_candidates", "symbols"), resolved)
    add("symbol_refs", ("resolved",), lambda t: t["resolved"].select(*page, "block_id", F.posexplode("parts").alias("part_ord", "p")).where("p.kind = 'symbol'").select(*page, "block_id", "part_ord", F.col("p.value").alias("symbol_id")))
    add("asset_manifest", ("resolved",), lambda t: t["resolved"].where("kind = 'figure' AND length(asset_ref) > 0").select(*page, "block_id", "asset_ref", "alt_text", "caption_block_id"))
    # plan_translation
    add("units", ("resolved", "pages"), lambda t: translation.plan_units(t["resolved"].join(t["pages"].where("route = 'facsimile'"), page, "left_anti")))
    add("hints", ("units", "terms"), lambda t: translation.glossary_hints(t["units"].select("unit_id", F.array_join("nodes.source_text", " ").alias("source")), t["terms"]))
    add("planned", ("units", "hints", "terms"), lambda t: translation.with_glossary(t["units"], t["hints"], t["terms"]))
    add("plan_summary", ("pages", "units"), lambda t: translation.plan_summary(t["pages"], t["units"]))
    add("estimate", ("planned",), lambda t: translation.estimate(translation.unit_sizes(t["planned"])))
    # translate_units
    add("results", ("planned", "memory"), lambda t: translation.translate_with_memory(t["planned"], t["memory"]))
    add("memory_new", ("planned", "memory", "results"), lambda t: translation.memory_store(t["memory"], translation.memory_rows(t["planned"], t["results"])))
    add("run_summary", ("results",), lambda t: translation.run_summary(t["results"]))
    # merge_localization
    add("localized", ("resolved", "results", "pages"), lambda t: t["resolved"].join(t["results"].select(F.regexp_replace("inline_id", r":i\d+$", "").alias("block_id"), "ru_text"), "block_id", "left").join(t["pages"].select(*page, "route"), page, "left").withColumn("route", F.coalesce("route", F.lit("semantic"))))
    # enrich_content
    add("glossary_links", ("localized", "terms"), glossary)
    add("navigation", ("localized",), lambda t: enrich.navigation(t["localized"]))
    add("contents", ("navigation",), lambda t: bundle.contents(t["navigation"]))
    add("search_documents", ("localized",), lambda t: enrich.search_documents(t["localized"]))
    add("doc_summary", ("localized",), lambda t: enrich.document_summary(t["localized"]))
    # evaluate_qa
    add("issues", ("localized", "resolved", "pages", "regions", "edges", "reading_order", "symbol_refs"), issues)
    add("issue_counts", ("issues",), lambda t: quality.by_category(t["issues"]))
    add("gate", ("issues", "localized"), lambda t: quality.gate_by_document(t["issues"], t["localized"]))
    # export_site_bundle
    add("bundle", ("localized",), lambda t: bundle.html(bundle.public_blocks(t["localized"], ("ru_text", "parts", "alt_text", "caption_block_id", "parent_block_id", "route"))).withColumn("render_mode", bundle.render_mode(F.col("route"), F.col("kind"))))
    # build_reader
    add("catalog_new", ("doc_summary", "titles", "catalog"), catalog)
    add("routes", ("doc_summary",), lambda t: bundle.routes(t["doc_summary"]))
    # index_search
    add("index_manifest", ("search_documents",), lambda t: enrich.index_manifest(t["search_documents"]))
    # package_release
    add("releases", ("doc_summary", "gate"), lambda t: t["doc_summary"].join(t["gate"], "doc_id").select(release_id(F.lit("run"), F.col("doc_id")).alias("release_id"), "doc_id", "page_count", "coverage", "errors", "warnings", "accepted"))
    return reg


def package(tables: Mapping[str, DataFrame], folder: str) -> list[dict]:
    """Writes the bundle of a run and an archive of each accepted document; returns their manifests.

    The list has a row a document and is walked on the driver.
    """
    from ..sinks import files

    out = os.path.join(folder, "site_bundle")
    files.write_bundle(tables["bundle"], out)
    done = []
    for row in tables["releases"].orderBy("doc_id").toLocalIterator():
        own = row.asDict()
        archive = os.path.join(folder, own["release_id"] + ".tar.gz")
        done.append(files.release(os.path.join(out, f"doc_id={own['doc_id']}"), archive, own, own["accepted"]))
    return done
