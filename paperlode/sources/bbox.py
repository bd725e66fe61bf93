"""Bounding-box XHTML to nested pages, parsed in Arrow batches: the built-in XML parser takes some 20 µs a word."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import accumulate
from operator import attrgetter, itemgetter
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BOUNDING_PAGE

# executors need not have this package
register_pickle_by_value(sys.modules[__name__])

#: Documents are parsed by so many characters at a time: their words are Python objects meanwhile.
CHUNK = 1 << 20


class InvalidBoxes(ValueError):
    def __init__(self, what: str):
        super().__init__(f"invalid extraction output: {what}")


class _Local(dict):
    """Names of elements without namespace."""

    def __missing__(self, tag: str) -> str:
        self[tag] = tag.rpartition("}")[2]
        return self[tag]


_local = _Local()


def _inside(e: ElementTree.Element | None, name: str) -> list[ElementTree.Element]:
    return [] if e is None else [x for x in e if _local[x.tag] == name]


def _last(e: ElementTree.Element | None, name: str) -> ElementTree.Element | None:
    return (_inside(e, name) or [None])[-1]


def _pages(xhtml: str | None) -> list[ElementTree.Element]:
    try:
        root = None if xhtml is None else ElementTree.fromstring(xhtml)
    except ElementTree.ParseError as e:
        raise InvalidBoxes(f"not well-formed ({e})") from e
    found = _inside(_last(_last(root, "body"), "doc"), "page") or _inside(_last(root, "doc"), "page") or _inside(root, "page")
    if not found:
        raise InvalidBoxes("no pages")
    return found


def _numbers(attributes: list[dict[str, str]], name: str) -> pa.Array:
    try:
        n = pc.cast(pc.utf8_trim_whitespace(pa.array(map(itemgetter(name), attributes), pa.string(), size=len(attributes))), pa.float32())
    except (KeyError, pa.ArrowInvalid):
        n = None
    if n is None or not np.isfinite(n.to_numpy(zero_copy_only=False)).all():
        raise InvalidBoxes(f"{name} is missing or not finite")
    return n


def _box(elements: list[ElementTree.Element]) -> dict[str, pa.Array]:
    attributes = list(map(attrgetter("attrib"), elements))
    low_x, low_y, high_x, high_y = (_numbers(attributes, n) for n in ("xMin", "yMin", "xMax", "yMax"))
    for low, high in ((low_x, high_x), (low_y, high_y)):
        if (high.to_numpy(zero_copy_only=False) < low.to_numpy(zero_copy_only=False)).any():
            raise InvalidBoxes("inverted box")
    return {"x_min": low_x, "y_min": low_y, "x_max": high_x, "y_max": high_y}


def _rows(**columns: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def _lists(groups: list[list], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, groups))], pa.int32()), values)


def _flat(groups: list[list]) -> list:
    return [x for g in groups for x in g]


def _text(word: ElementTree.Element) -> str:
    """A word's text; blanks alone are none."""
    text = "".join([word.text or "", *(x.tail or "" for x in word)]) if len(word) else word.text
    return "" if text is None or text.isspace() else text


def _parsed(texts: list[str | None]) -> pa.ListArray:
    pages_of = [_pages(x) for x in texts]
    pages = _flat(pages_of)
    blocks_of = [_flat([_inside(f, "block") for f in _inside(p, "flow")]) + _inside(p, "block") for p in pages]
    blocks = _flat(blocks_of)
    lines_of = [_inside(b, "line") for b in blocks]
    lines = _flat(lines_of)
    words_of = [_inside(x, "word") for x in lines]
    words = _flat(words_of)
    text = pa.array(map(_text, words), pa.string(), size=len(words))
    rows = _rows(**_box(lines), words=_lists(words_of, _rows(text=text, **_box(words))))
    rows = _rows(**_box(blocks), lines=_lists(lines_of, rows))
    sizes = list(map(attrgetter("attrib"), pages))
    return _lists(pages_of, _rows(width=_numbers(sizes, "width"), height=_numbers(sizes, "height"), blocks=_lists(blocks_of, rows)))


def _chunks(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    part, n = [], 0
    for x in texts:
        part.append(x)
        n += len(x or "")
        if n >= CHUNK:
            yield part
            part, n = [], 0
    yield part


def _parse(xhtml: pa.Array) -> pa.Array:
    return pa.concat_arrays([_parsed(part) for part in _chunks(x.as_py() for x in xhtml)])


def parse_bbox_layout(xhtml: Column) -> Column:
    """array of bounding pages of one document per row.

    flow is transparent, other elements are left out, entities are decoded. Missing or non-finite
    numbers, inverted boxes and documents without pages fail the query; negative numbers don't.
    """
    return F.arrow_udf(_parse, f"array<{BOUNDING_PAGE}>")(xhtml)
