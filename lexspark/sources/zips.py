"""ZIP batches: members with decoded names and digests; archives among the attachments are opened in place.

Every archive is read member by member in pieces. Contents leave the task only where they are asked for.
"""

from __future__ import annotations

import hashlib
import io
import re
import stat
import unicodedata
import zipfile
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.operators.intake import JUNK_FOLDERS, JUNK_NAMES, path_fault

MAX_DEPTH = 3  # archives within one another that are opened
NAME_BYTES = 222
SCHEMA = "zip string, ord int, path string, bytes long, sha256 string, content binary, error string"
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError, pa.ArrowException)
_UNSAFE = re.compile(r"/|[A-Za-z]:")


def member_name(info: zipfile.ZipInfo) -> tuple[str, str | None]:
    """A member's path, composed and with forward slashes, and why it is refused: filename_encoding, path_unsafe or null.

    Names without the UTF-8 flag are bytes of UTF-8, or else of the Korean code page.
    """
    name = info.filename
    if not info.flag_bits & 0x800:
        raw, name = name.encode("cp437", "replace"), None
        for code in ("utf-8", "cp949"):
            try:
                name = raw.decode(code)
                break
            except UnicodeDecodeError:
                pass
        if name is None:
            return raw.decode("utf-8", "replace"), "filename_encoding"
    name = unicodedata.normalize("NFC", name.replace("\\", "/"))
    steps = [s for s in name.split("/") if s not in ("", ".")]
    if _UNSAFE.match(name) or ".." in steps or not steps or stat.S_ISLNK(info.external_attr >> 16):
        return name, "path_unsafe"
    return "/".join(steps), None


def is_junk(path: str) -> bool:
    top, _, _ = path.partition("/")
    return top in JUNK_FOLDERS or path.rpartition("/")[2] in JUNK_NAMES


def fit_name(name: str, budget: int = NAME_BYTES) -> str:
    """The name within so many bytes of UTF-8: its stem is cut, its extension stays."""
    stem, dot, tail = name.rpartition(".")
    if not stem:
        stem, dot, tail = name, "", ""
    room = max(budget - len((dot + tail).encode()), 0)
    return name if len(stem.encode()) <= room else stem.encode()[:room].decode(errors="ignore") + dot + tail


def _stem(name: str) -> str:
    return name.rpartition(".")[0] or name


def _inside(blob: bytes, stem: str, depth: int) -> Iterator[tuple[str, Callable[[], bytes]]]:
    """(name, reader) of the files in an attached archive and in those within it; documents in it are none of the delivery."""
    if depth > MAX_DEPTH:
        return
    archive = zipfile.ZipFile(io.BytesIO(blob))
    for info in archive.infolist():
        path, fault = member_name(info)
        if info.is_dir() or fault or is_junk(path):
            continue
        base = path.rpartition("/")[2]
        if base.lower().endswith(".zip"):
            yield from _inside(archive.read(info), f"{stem}__{_stem(base)}", depth + 1)
        elif not base.lower().endswith(".json"):
            yield f"{stem}__{base}", lambda info=info: archive.read(info)


def members(blob: bytes | BinaryIO) -> Iterator[tuple[str, str | None, Callable[[], bytes] | None]]:
    """(path, fault, reader) of all files of a delivery.

    An attached archive gives its files beside it as {stem}__{name}, with a number where a name is taken; one that
    can't be read stays a member (of an unsupported kind). Two members of one path are both refused.
    """
    archive = zipfile.ZipFile(io.BytesIO(blob) if isinstance(blob, bytes) else blob)
    plain, nested = [], []
    for info in archive.infolist():
        if info.is_dir():
            continue
        path, fault = member_name(info)
        (nested if not fault and path.lower().endswith(".zip") else plain).append((path, fault, info))
    taken = {path for path, fault, _ in plain if not fault}
    times = Counter(path for path, fault, _ in plain if not fault and not is_junk(path))
    for path, fault, info in plain:
        yield path, fault or ("path_duplicate" if times[path] > 1 else None), lambda info=info: archive.read(info)
    for path, _, info in nested:
        folder, _, name = path.rpartition("/")
        data = archive.read(info)
        try:
            found = list(_inside(data, _stem(name), 1))
        except BROKEN:
            yield path, None, lambda data=data: data
            continue
        for name, read in found:
            name = whole = fit_name(name)
            k = 0
            while (at := f"{folder}/{name}" if folder else name) in taken:
                k += 1
                dot = whole[len(_stem(whole)) :] if "." in whole[1:] else ""
                name = fit_name(f"{_stem(whole)}_{k}{dot}")
            taken.add(at)
            yield at, None, read


def _row(*values) -> pa.RecordBatch:
    types = pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["zip", "ord", "path", "bytes", "sha256", "content", "error"])


def _digest(f: BinaryIO) -> str:
    h = hashlib.sha256()
    while piece := f.read(1 << 20):
        h.update(piece)
    return h.hexdigest()


def rows_of(name: str, f: BinaryIO, size: int, content: bool = True) -> Iterator[pa.RecordBatch]:
    """A row for each member of an archive that can be sought in; a member that can't be read to its end faults the whole delivery."""
    try:
        archive = zipfile.ZipFile(f)
        for info in archive.infolist():
            with archive.open(info) as member:
                while member.read(1 << 20):
                    pass
    except BROKEN:
        f.seek(0)
        yield _row(name, 0, None, size, _digest(f), None, "zip_corrupt")
        return
    for k, (path, fault, read) in enumerate(members(f)):
        try:
            data = read()
        except BROKEN:
            yield _row(name, k, path, None, None, None, fault or "zip_corrupt")
            continue
        yield _row(name, k, path, len(data), hashlib.sha256(data).hexdigest(), data if content and not fault else None, fault)


def _open(content: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, blob in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                yield from rows_of(path, io.BytesIO(blob), len(blob), content)

    return run


def read_zips(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Every member of every ZIP below path; the fault of its path where reading found none. content: the bytes too."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return files.mapInArrow(_open(content), SCHEMA).withColumn("error", F.coalesce("error", F.when(F.col("path").isNotNull(), path_fault(F.col("path")))))


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """zip (its path), manifest (VARIANT) and error of the manifest beside each ZIP: {stem}.manifest.json, or else {stem}.zip.manifest.json."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.manifest.json").select(F.col("_metadata.file_path").alias("file"), "value")
    own = F.endswith("file", F.lit(".zip.manifest.json"))
    named = files.select(F.concat(F.regexp_replace("file", r"(\.zip)?\.manifest\.json$", ""), F.lit(".zip")).alias("zip"), own.cast("int").alias("rank"), F.regexp_replace("value", "^\ufeff", "").alias("value"))
    best = named.groupBy("zip").agg(F.min_by("value", "rank").alias("value"))
    parsed = F.try_parse_json("value")
    good = F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    return best.select("zip", F.when(good, parsed).alias("manifest"), F.when(parsed.isNull() | ~good, "manifest_invalid").alias("error"))
