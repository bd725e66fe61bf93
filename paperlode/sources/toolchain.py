"""The external text extraction tools, behind one interface that tests can replace."""

from __future__ import annotations

import os
import subprocess
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from ..errors import CommandError, InvalidExtraction, ToolOutputError


def _run(command: list[str]) -> tuple[str, str]:
    try:
        done = subprocess.run(command, capture_output=True, check=False)
    except OSError as e:
        raise CommandError(command[0], "not started", str(e)) from e
    out, err = done.stdout.decode("utf-8", "replace"), done.stderr.decode("utf-8", "replace")
    if done.returncode:
        raise CommandError(command[0], done.returncode, err[:4096])
    return out, err


def _version(command: str) -> str:
    out, err = _run([command, "-v"])
    found = next((w for w in (out + err).split() if w[0] in "0123456789"), None)
    if found is None:
        raise ToolOutputError("version")
    return found


def _value(text: str, label: str) -> str:
    line = next((x for x in text.splitlines() if x.startswith(label)), None)
    if line is None:
        raise ToolOutputError(label.rstrip(":"))
    return line[len(label) :].strip()


def _count(text: str, field: str) -> int:
    if not text.isdigit():
        raise ToolOutputError(field)
    return int(text)


@dataclass(frozen=True)
class PdfMetadata:
    pages: int
    encrypted: bool
    file_size: int
    pdf_version: str


@dataclass(frozen=True)
class PopplerToolchain:
    pdfinfo: str
    pdftotext: str
    version: str

    @classmethod
    def probe(cls, pdfinfo: str = "pdfinfo", pdftotext: str = "pdftotext") -> PopplerToolchain:
        """Both tools must be there, in the same version."""
        versions = [_version(pdfinfo), _version(pdftotext)]
        if versions[0] != versions[1]:
            raise InvalidExtraction(f"tool versions differ: {versions[0]} and {versions[1]}")
        return cls(pdfinfo, pdftotext, versions[0])

    def pdf_metadata(self, path: str) -> PdfMetadata:
        out, _ = _run([self.pdfinfo, path])
        size = _value(out, "File size:").split()
        return PdfMetadata(_count(_value(out, "Pages:"), "Pages"), _value(out, "Encrypted:") != "no", _count(size[0] if size else "", "File size"), _value(out, "PDF version:"))

    def extract(self, path: str, folder: str) -> tuple[str, str]:
        """Layout text and bounding boxes (XHTML) of a document; folder takes the tools' files."""
        layout, boxes = os.path.join(folder, "layout.txt"), os.path.join(folder, "bbox.xhtml")
        _run([self.pdftotext, "-layout", "-enc", "UTF-8", path, layout])
        _run([self.pdftotext, "-bbox-layout", "-enc", "UTF-8", path, boxes])
        texts = []
        for name in (layout, boxes):
            with open(name, encoding="utf-8", newline="") as f:
                texts.append(f.read())
        return texts[0], texts[1]


def check_metadata(manifest: dict, found: PdfMetadata) -> None:
    if found.encrypted:
        raise InvalidExtraction(f"{manifest['source_id']} is encrypted")
    if found.pages != manifest["page_count"] or found.file_size != manifest["byte_size"]:
        raise InvalidExtraction(f"{manifest['source_id']} differs from its manifest in pages or size")


def extract_sources(files: DataFrame, toolchain: PopplerToolchain) -> DataFrame:
    """source_id, layout_text and bbox_xhtml for files (source_id, content), one document at a time
    on the executors. The tools need files, which last as long as one document does."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source_id, content in zip(batch.source_id, batch.content):
                with tempfile.TemporaryDirectory() as folder:
                    path = os.path.join(folder, "source.pdf")
                    with open(path, "wb") as f:
                        f.write(content)
                    layout, boxes = toolchain.extract(path, folder)
                yield pd.DataFrame({"source_id": [source_id], "layout_text": [layout], "bbox_xhtml": [boxes]})

    return files.select("source_id", "content").mapInPandas(run, "source_id string, layout_text string, bbox_xhtml string")
