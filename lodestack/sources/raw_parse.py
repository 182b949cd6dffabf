"""Raw parser output brought to one shape: texts, tables and pages of documents.

The raw JSON has no fixed types (pages may be a mapping or a list, table data anything), so it is read in Python,
a document at a time; what comes out has the schema of parse artifacts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from lodestack.sources.files import STRUCTURE

SCHEMA = f"{STRUCTURE}, pages array<struct<page: int, width: double, height: double>>"


def _is_page(x: object) -> bool:
    return isinstance(x, int) and not isinstance(x, bool)


def _on_pages(item: dict) -> list[int]:
    """The pages an item comes from, each once, in order."""
    told = [p.get("page_no") for p in item.get("prov") or () if isinstance(p, dict)]
    return list(dict.fromkeys(p for p in told if _is_page(p)))


def normalized(doc_id: str, raw: dict, told_pages: int | None = None) -> dict:
    """One document. The page count is the number of listed pages, else what the parser tells, else 0; pages without a number go."""
    listed = raw.get("pages")
    pages = list(listed.values()) if isinstance(listed, dict) else listed if isinstance(listed, list) else None
    texts = [{"self_ref": x.get("self_ref"), "label": str(x.get("label", "")), "text": str(x.get("text", "")), "pages": _on_pages(x)} for x in raw.get("texts") or ()]
    tables = []
    for x in raw.get("tables") or ():
        data = x["data"] if isinstance(x.get("data"), list) else []
        tables.append({"self_ref": x.get("self_ref"), "pages": _on_pages(x), "data": [[str(c) for c in row] for row in data if isinstance(row, list)]})
    sized = []
    for p in pages or ():
        if isinstance(p, dict) and _is_page(p.get("page_no")):
            size = p["size"] if isinstance(p.get("size"), dict) else {}
            sized.append({"page": p["page_no"], "width": float(size["width"]) if "width" in size else None, "height": float(size["height"]) if "height" in size else None})
    return {"doc_id": doc_id, "page_count": len(pages) if pages is not None else told_pages or 0, "texts": texts, "tables": tables, "pages": sized}


def normalized_structures(raws: DataFrame) -> DataFrame:
    """Parse artifacts of rows (doc_id, raw: JSON text, told_pages). JSON that isn't a mapping is an empty document."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, raw, told in zip(batch["doc_id"], batch["raw"], batch["told_pages"], strict=True):
                try:
                    own = json.loads(raw)
                except ValueError:
                    own = {}
                rows.append(normalized(doc_id, own if isinstance(own, dict) else {}, None if pd.isna(told) else int(told)))
            yield pd.DataFrame(rows, columns=["doc_id", "page_count", "texts", "tables", "pages"])

    return raws.select("doc_id", "raw", "told_pages").mapInPandas(read, SCHEMA)
