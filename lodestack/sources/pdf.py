"""What is on the pages of PDF files, told by the operators of their content streams.

Reads objects and object streams, plain or compressed by Flate; other filters' pages count as empty. No text is
extracted. A file is one row, so its pages are scanned by one task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "path string, page int, width_inches double, height_inches double, has_text boolean, has_vector boolean"
# Operators that show text and that draw paths.
TEXT = frozenset({b"TJ", b"Tj", b"'", b'"'})
VECTOR = frozenset({b"S", b"s", b"f", b"F", b"f*", b"B", b"B*", b"b", b"b*", b"m", b"l", b"c", b"v", b"y", b"h", b"re"})
_OBJECT = re.compile(rb"(?<!\d)(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_TOKEN = re.compile(rb"%[^\r\n]*|\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<<|>>|<[0-9A-Fa-f\s]*>|BI\b.*?\bEI\b|[^\s()<>\[\]{}/%]+|/[^\s()<>\[\]{}/%]*|[\[\]{}]", re.S)
_BOX = re.compile(rb"/MediaBox\s*\[\s*([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)\s*\]")
_REF = re.compile(rb"(\d+)\s+\d+\s+R\b")


def _content(body: bytes) -> bytes:
    """An object's stream, decompressed."""
    found = _STREAM.search(body)
    if not found:
        return b""
    head = body[: found.start()]
    if b"/FlateDecode" in head:
        try:
            return zlib.decompressobj().decompress(found[1])
        except zlib.error:
            return b""
    return b"" if b"/Filter" in head else found[1]


def _objects(raw: bytes) -> dict[int, bytes]:
    held = {int(m[1]): m[2] for m in _OBJECT.finditer(raw)}
    for body in list(held.values()):
        if b"/ObjStm" in body:
            first = re.search(rb"/First\s+(\d+)", body)
            inner = _content(body)
            if first and inner:
                at = int(first[1])
                numbers = [int(x) for x in inner[:at].split()]
                places = list(zip(numbers[::2], numbers[1::2], strict=False))
                ends = [p for _, p in places[1:]] + [len(inner) - at]
                held.update({n: inner[at + p : at + e] for (n, p), e in zip(places, ends, strict=True)})
    return held


def _box(page: bytes, objects: dict[int, bytes]) -> tuple[float, float]:
    """A page's width and height in inches, at least 1; its own box or that of the nearest node above."""
    seen = 0
    while seen < 50:
        found = _BOX.search(page)
        if found:
            x0, y0, x1, y1 = (float(v) for v in found.groups())
            return max((x1 - x0) / 72, 1.0), max((y1 - y0) / 72, 1.0)
        above = re.search(rb"/Parent\s+(\d+)\s+\d+\s+R", page)
        if not above or int(above[1]) not in objects:
            break
        page, seen = objects[int(above[1])], seen + 1
    return 8.5, 11.0


def scan(raw: bytes) -> list[tuple[int, float, float, bool, bool]]:
    """(page from 1, width, height, whether it shows text, whether it draws paths) of a file's pages, in order of their objects' tree."""
    objects = _objects(raw)
    order: list[int] = []

    def under(n: int, depth: int) -> None:
        body = objects.get(n, b"")
        kids = re.search(rb"/Kids\s*\[(.*?)\]", body, re.S)
        if kids and depth < 100:
            for ref in _REF.findall(kids[1]):
                under(int(ref), depth + 1)
        elif re.search(rb"/Type\s*/Page\b(?!s)", body):
            order.append(n)

    roots = [n for n, body in objects.items() if re.search(rb"/Type\s*/Pages\b", body) and not re.search(rb"/Parent\b", body)]
    for n in roots:
        under(n, 0)
    out = []
    for place, n in enumerate(order or [n for n, body in sorted(objects.items()) if re.search(rb"/Type\s*/Page\b(?!s)", body)], 1):
        page = objects[n]
        contents = re.search(rb"/Contents\s*(\[.*?\]|\d+\s+\d+\s+R)", page, re.S)
        text = vector = False
        for ref in _REF.findall(contents[1]) if contents else ():
            for m in _TOKEN.finditer(_content(objects.get(int(ref), b""))):
                text |= m[0] in TEXT
                vector |= m[0] in VECTOR
                if text and vector:
                    break
        out.append((place, *_box(page, objects), text, vector))
    return out


def pages(spark: SparkSession, path: str) -> DataFrame:
    """One row for each page of the PDF files under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(where, *row) for where, raw in zip(batch["path"], batch["content"], strict=True) for row in scan(bytes(raw))]
            yield pd.DataFrame(rows, columns=["path", "page", "width_inches", "height_inches", "has_text", "has_vector"])

    return files.mapInPandas(read, SCHEMA)
