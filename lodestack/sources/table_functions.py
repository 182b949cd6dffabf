"""Table functions for SQL: texts taken apart in a LATERAL, row by row."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_HEAD = re.compile(r"\A---\n(.*?)\n---\n?(.*)\Z", re.DOTALL)
_MARKS = re.compile(r"(#{1,6})\s+(?=\S)", re.ASCII)


class MarkdownItems:
    """The items of a Markdown text: paragraphs between blank lines, headings by their marks, in order."""

    def eval(self, text: str | None) -> Iterator[tuple]:
        kept = (p for p in re.split(r"\n[ \t]*\n", text) if p.strip(" ")) if text is not None else ()
        for idx, part in enumerate(kept):
            body = part.strip()
            marks = _MARKS.match(body)
            if marks:
                yield idx, "section_header", body[marks.end() :], len(marks[1])
            else:
                yield idx, "text", body, None


class PageParts:
    """The YAML head and the body of a Markdown page; a page without a head is all body. Line ends may be CRLF."""

    def eval(self, text: str | None) -> Iterator[tuple]:
        if text is not None:
            plain = text.replace("\r\n", "\n")
            found = _HEAD.match(plain)
            yield (found[1], found[2]) if found else (None, plain)


def register(spark: SparkSession) -> None:
    """``FROM docs, LATERAL markdown_items(docs.text)`` and ``LATERAL page_parts(docs.text)`` in this session's SQL."""
    spark.udtf.register("markdown_items", F.udtf(MarkdownItems, returnType="idx bigint, label string, text string, level int"))
    spark.udtf.register("page_parts", F.udtf(PageParts, returnType="head string, body string"))
