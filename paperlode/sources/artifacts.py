"""Deterministic files: JSON and JSON Lines writers, artifact listing, digest and atomic publishing."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import struct
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import WriteError

#: Files that a digest leaves out, in any folder.
NOT_DIGESTED = {"run.json", ".gitkeep"}


def write_text(path: str, text: str | Iterable[str]) -> None:
    try:
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with open(path, "w", encoding="utf-8", newline="") as f:
            f.writelines([text] if isinstance(text, str) else text)
    except OSError as e:
        raise WriteError(path, e) from e


def write_json(path: str, value: object) -> None:
    write_text(path, json.dumps(value, indent=2, ensure_ascii=False) + "\n")


def json_row(*columns: str) -> Column:
    """A row as one line of JSON, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_jsonl(path: str, rows: DataFrame, columns: list[str], order: list[str]) -> None:
    """One line for each row, in order; rows pass through the driver one partition at a time."""
    lines = rows.orderBy(*order).select(json_row(*columns).alias("line"))
    write_text(path, (r.line + "\n" for r in lines.toLocalIterator()))


def artifact_files(root: str) -> Iterator[tuple[str, str]]:
    """Relative path (with /) and path of each digested file, by relative path."""
    found = []
    for folder, _, names in os.walk(root):
        for name in names:
            if name not in NOT_DIGESTED:
                path = os.path.join(folder, name)
                found.append((os.path.relpath(path, root).replace(os.sep, "/"), path))
    yield from sorted(found, key=lambda x: x[0].encode())


def semantic_digest(files: Iterable[tuple[str, bytes]]) -> str:
    """SHA-256 over path and content of all files, in path order, each after its 64-bit length."""
    h = hashlib.sha256()
    for path, content in sorted((p.encode(), c) for p, c in files):
        for part in (path, content):
            h.update(struct.pack(">Q", len(part)) + part)
    return h.hexdigest()


def folder_digest(root: str) -> str:
    """The same digest of the files in a folder, one of them in memory at a time."""
    h = hashlib.sha256()
    for name, path in artifact_files(root):
        with open(path, "rb") as f:
            for part in (name.encode(), f.read()):
                h.update(struct.pack(">Q", len(part)) + part)
    return h.hexdigest()


def digest_of(artifacts: DataFrame, keys: list[str]) -> DataFrame:
    """keys and digest of artifacts (path, content), for each group of keys."""

    def framed(x: Column) -> Column:
        return F.concat(F.lpad(F.hex(F.octet_length(x)), 16, "0"), F.hex(x))

    one = F.struct(F.col("path").cast("binary").alias("path"), F.concat(framed(F.col("path").cast("binary")), framed(F.col("content").cast("binary"))).alias("framed"))
    rows = artifacts.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("all"))
    whole = F.unhex(F.array_join(F.transform("all", lambda x: x["framed"]), ""))
    return rows.select(*keys, F.sha2(whole, 256).alias("digest"))


def publish(stage: str, destination: str) -> None:
    """Puts the folder stage in the place of destination; if that fails the old one stays."""
    backup = f"{destination}.backup-{os.getpid()}"
    try:
        os.makedirs(os.path.dirname(destination) or ".", exist_ok=True)
        shutil.rmtree(backup, ignore_errors=True)
        old = os.path.exists(destination)
        if old:
            os.rename(destination, backup)
        try:
            os.rename(stage, destination)
        except OSError:
            if old:
                os.rename(backup, destination)
            raise
        shutil.rmtree(backup, ignore_errors=True)
    except OSError as e:
        raise WriteError(destination, e) from e
