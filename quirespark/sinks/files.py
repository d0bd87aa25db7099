"""Sinks: canonical JSON, JSON lines, page bundles, assets and releases."""

from __future__ import annotations

import hashlib
import io
import json
import tarfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage

# Extensions that may leave with a bundle.
ASSETS = ("png", "jpeg", "jpg", "gif", "svg", "webp")


def canonical_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as JSON with its columns in order of name."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])).alias(name))


def write_json(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines; files appear when the job commits."""
    df.write.mode("append" if append else "overwrite").json(path)


def write_bundle(pages: DataFrame, path: str, partitions: int | None = None) -> None:
    """Pages by document; documents that are written replace their folder, others stay."""
    rows = pages.repartition(partitions, "doc_id", "page_number") if partitions else pages
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc_id").parquet(path)


def inventory(df_of_files: DataFrame) -> DataFrame:
    """Number and bytes of the files of a binary listing by extension; others than assets, JSON and Parquet are left out."""
    ext = F.lower(F.element_at(F.split("path", r"\."), -1))
    return df_of_files.withColumn("extension", ext).where(F.col("extension").isin(*ASSETS, "json", "parquet")).groupBy("extension").agg(F.count(F.lit(1)).alias("files"), F.sum("file_size_bytes").alias("bytes"))


def write_binaries(images: DataFrame, folder: str, name: str = "content_hash", content: str = "content", extension: str = "extension") -> DataFrame:
    """Each distinct content once, named by the start of its hash; returns the written paths.

    ``folder`` is a URI or a folder that all executors share.  Writing is
    idempotent: a file that exists is left, so a repeated task does no harm.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = storage.system(folder)
        files.create_dir(base, recursive=True)
        for part in parts:
            done = []
            for key, data, ext in zip(part[name], part[content], part[extension]):
                path = f"{base}/{key[:16]}.{ext}"
                if not files.get_file_info(path).is_file:
                    half = f"{path}.{uuid.uuid4().hex}.part"
                    with files.open_output_stream(half) as f:
                        f.write(data)
                    files.move(half, path)
                done.append(path)
            yield pd.DataFrame({"path": done})

    kept = images.where(F.lower(extension).isin(*ASSETS)).dropDuplicates([name])
    return kept.select(name, content, extension).mapInPandas(run, "path string")


def file_hash(path: str) -> str:
    files, at = storage.system(path)
    digest = hashlib.sha256()
    with files.open_input_stream(at) as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def folder_hash(folder: str) -> str | None:
    """SHA-256 over the sorted relative paths and contents of a folder, subfolders too; None where it holds nothing."""
    digest, any_ = hashlib.sha256(), False
    for name, path in storage.walk(folder):
        any_ = True
        digest.update(name.encode())
        digest.update(bytes.fromhex(file_hash(_whole(folder, path))))
    return digest.hexdigest() if any_ else None


def output_hashes(folder: str, leave_out: tuple[str, ...] = ("stage_manifest.json",)) -> dict[str, str]:
    """SHA-256 of each file that lies in a folder itself, by name, without the manifest of its stage."""
    return {name: file_hash(_whole(folder, path)) for name, path in storage.walk(folder) if "/" not in name and name not in leave_out}


def _whole(folder: str, path: str) -> str:
    """A path of a folder's file system with the folder's scheme."""
    return f"{folder.split('://', 1)[0]}://{path.lstrip('/') if not folder.startswith('file:') else path}" if "://" in folder else path


def release(folder: str, archive: str, manifest: dict, accepted: bool) -> dict:
    """A tar.gz of the sorted files of a bundle with its manifest; without acceptance only the manifest.

    Files are read and the archive is written where ``folder`` and ``archive`` say.
    """
    out = dict(manifest, accepted=accepted)
    if accepted:
        source, _ = storage.system(folder)
        target, at = storage.system(archive)
        with target.open_output_stream(at) as raw_out, tarfile.open(fileobj=raw_out, mode="w|gz") as tar:
            for name, path in storage.walk(folder):
                info = tarfile.TarInfo(name)
                info.size = source.get_file_info(path).size
                with source.open_input_stream(path) as f:
                    tar.addfile(info, f)
            raw = json.dumps(manifest, sort_keys=True, indent=2, default=str).encode()
            info = tarfile.TarInfo("release_manifest.json")
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
        out |= {"archive": archive, "size_bytes": target.get_file_info(at).size, "sha256": file_hash(archive)}
    return out
