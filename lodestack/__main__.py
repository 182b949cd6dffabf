"""Commands on stores and tables.

list | run NAME DIR [ROWS] | explain NAME DIR          the registered queries
doctor                                                  what this installation can do
intake files DIR | intake pack FILE | intake missing FILE DIR
normalize pages DIR                                     what is on the pages of PDF files
parse items DIR | parse quality DIR                     text items and scores of test tables
section DIR | section types DIR | section steps DIR
extract items DIR | extract offline DIR                 work items, and the offline backend's results
run status DIR | run batches DIR | run budget DIR
claims contradictions DIR | claims supersessions DIR
compile topics DIR | compile notes DIR
publish diff DIR | publish validate DIR
eval parser DIR | eval extraction DIR
inference cost DIR
"""

from __future__ import annotations

import sys

from lodestack.plans import registry
from lodestack.session import get_session

#: Commands that are registered queries over a folder of tables.
NAMED = {
    ("parse", "items"): "text_items", ("parse", "quality"): "parse_quality", ("section", "types"): "section_classify", ("section", "steps"): "section_steps",
    ("extract", "items"): "work_items", ("extract", "offline"): "extract_offline", ("run", "status"): "run_metrics", ("run", "batches"): "batch_chunks", ("run", "budget"): "rolling_budget",
    ("claims", "contradictions"): "contradictions_spec", ("claims", "supersessions"): "supersession", ("compile", "topics"): "topic_classify", ("compile", "notes"): "note_entries",
    ("publish", "diff"): "publish_diff", ("publish", "validate"): "publish_validate", ("eval", "parser"): "eval_parser", ("eval", "extraction"): "eval_extraction", ("inference", "cost"): "cost_rollup",
    ("intake", "bucket"): "bucket_assign", ("intake", "status"): "status_current", ("analyze", "review"): "review_merge", ("analyze", "bucket"): "contradiction_order", ("publish", "log"): "publish_files",
    ("inference", "batch-status"): "batch_stats", ("inference", "batch-ingest"): "batch_results", ("inference", "log"): "log_usage_stream", ("extract", "records"): "record_store", ("extract", "retry-failed"): "batch_retries",
}


def _doctor() -> int:
    import importlib.util

    needed = {name: importlib.util.find_spec(name) is not None for name in ("pyspark", "pyarrow", "pandas", "numpy", "yaml")}
    for name, found in needed.items():
        print(f"{name}: {'found' if found else 'missing'}")
    return 0 if all(needed.values()) else 1


def main(args: list[str]) -> int:
    known = registry.queries()
    match args:
        case ["list"]:
            print("\n".join(sorted(known)))
        case ["doctor"]:
            return _doctor()
        case ["explain", name, folder] if name in known:
            known[name](get_session(), folder).explain("formatted")
        case ["run", name, folder, *rows] if name in known:
            known[name](get_session(), folder).show(int(rows[0]) if rows else 20, truncate=False)
        case [group, verb, folder] if NAMED.get((group, verb)) in known:
            known[NAMED[group, verb]](get_session(), folder).show(20, truncate=False)
        case ["section", folder]:
            known["sections"](get_session(), folder).show(20, truncate=False)
        case ["intake", "files", folder]:
            from lodestack.sources.files import raw_files

            raw_files(get_session(), folder).drop("content").show(20, truncate=False)
        case ["intake", "pack", file]:
            from lodestack.sources.packs import source_pack

            source_pack(get_session(), file).show(20, truncate=False)
        case ["intake", "missing", file, folder]:
            from lodestack.sources.files import raw_files
            from lodestack.sources.packs import missing_files, selected, source_pack

            spark = get_session()
            missing_files(selected(source_pack(spark, file)), raw_files(spark, folder)).show(20, truncate=False)
        case ["normalize", "pages", folder]:
            from lodestack.sources.pdf import pages

            pages(get_session(), folder).show(20, truncate=False)
        case _:
            print(__doc__)
            return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
