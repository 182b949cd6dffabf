"""Source packs and settings: small YAML files that the driver reads."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACK = "filename string, include string, manufacturer string, family string, document_type string, revision string"
#: Settings that the environment may overlay: LODESTACK_ and the path in capitals; how each is read.
OVERLAYS: dict[tuple[str, ...], Callable[[str], Any]] = {
    ("api_key_env",): str, ("default_model",): str, ("extraction_model",): str, ("compilation_model",): str, ("temperature",): float, ("max_tokens",): int,
    ("rate_limit", "max_requests_per_minute"): int, ("rate_limit", "max_tokens_per_minute"): int,
    ("batch", "max_batch_size"): int, ("batch", "poll_interval_seconds"): int, ("batch", "max_poll_duration_seconds"): int,
    ("extraction", "strategy"): str, ("extraction", "direct_concurrency"): int, ("extraction", "batch_chunk_size"): int,
    ("extraction", "token_estimate_chars_per_token"): float, ("extraction", "dispatch_cooldown_seconds"): float,
}
# Settings of normalization and the score that a parse must reach.
NORMALIZATION = {
    "language": "eng", "deskew": True, "clean": True, "optimize": 1, "text_density_threshold": 50.0, "confidence_density_target": 200.0, "skip_vector_pages": True,
    "fast_text_detection_page_threshold": 25, "bypass_document_types": (),
}
QUALITY_GATE = 70.0


def load_yaml(path: str) -> dict[str, Any]:
    """A mapping from a YAML file; an error if it holds anything else."""
    import yaml

    own = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    if not isinstance(own, dict):
        raise ValueError(f"not a mapping: {path}")
    return own


def settings(path: str, environ: Mapping[str, str] | None = None) -> dict[str, Any]:
    """Settings of a YAML file, overlaid by the environment."""
    found = load_yaml(path)
    known = os.environ if environ is None else environ
    for place, read in OVERLAYS.items():
        name = "LODESTACK_" + "_".join(place).upper()
        if name in known:
            inner = found
            for step in place[:-1]:
                inner[step] = dict(inner.get(step) or {})
                inner = inner[step]
            inner[place[-1]] = read(known[name])
    return found


def normalization(path: str) -> dict[str, Any]:
    """Normalization settings: the usual ones, but for those under stages.normalize of a YAML file, if it is there."""
    if not Path(path).exists():
        return dict(NORMALIZATION)
    own = (load_yaml(path).get("stages") or {}).get("normalize") or {}
    out = NORMALIZATION | {k: own[k] for k in NORMALIZATION if k in own}
    return out | {"bypass_document_types": tuple(map(str, out["bypass_document_types"]))}


def quality_gate(path: str) -> float:
    """The least score of a parse that passes."""
    if not Path(path).exists():
        return QUALITY_GATE
    return float(((load_yaml(path).get("stages") or {}).get("parse") or {}).get("quality_threshold", QUALITY_GATE))


def source_pack(spark: SparkSession, path: str) -> DataFrame:
    """The documents that a pack lists, in order, with the paths of their files; its source_dir is relative to the pack."""
    own = load_yaml(path)
    folder = (Path(path).resolve().parent / str(own.get("source_dir", "."))).resolve()
    names = [x.split()[0] for x in PACK.split(", ")]
    rows = [(n, *[None if d.get(k) is None else str(d[k]) for k in names], str(folder / str(d.get("filename")))) for n, d in enumerate(own.get("documents") or ())]
    return spark.createDataFrame(rows, f"ordinal int, {PACK}, path string").withColumn("include", F.coalesce("include", F.lit("required")))


def selected(pack: DataFrame, conditionals: bool = False) -> DataFrame:
    """The documents of a pack that are to be registered: conditional ones only if asked for."""
    return pack if conditionals else pack.where("include <> 'conditional'")


def missing_files(pack: DataFrame, files: DataFrame) -> DataFrame:
    """Documents of a pack whose file (by name) isn't among the files (path)."""
    held = files.select(F.element_at(F.split("path", "/"), -1).alias("filename")).distinct()
    return pack.join(held, "filename", "left_anti")
