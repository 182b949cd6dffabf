"""Whole documents through headings, sections, types, steps and figure regions."""

from pyspark.sql import functions as F

from lodestack.operators import sectioning as A
from lodestack.operators import structure as O


def through(spark, lines, tables=(), kind="datasheet", doc_class="authoritative-technical"):
    rows = [(1, n, label, text, page) for n, (label, text, page) in enumerate(lines)]
    items = spark.createDataFrame(rows, "doc_id long, idx long, label string, text string, page long").withColumn("level", A.label_level(F.col("label")))
    held = spark.createDataFrame([(1, n, page, data) for n, (page, data) in enumerate(tables)], "doc_id long, table_no long, page long, data array<array<string>>")
    numbered = A.numbered(items)
    sections = A.sections(numbered, held).withColumn("document_type", F.lit(kind)).withColumn("document_class", F.lit(doc_class))
    typed = O.classify(sections).withColumn("operational", F.lit(doc_class == "operational"))
    by_number = lambda df, order: [r for r in df.orderBy("section_no", order).collect()]
    return by_number(typed, "doc_id"), by_number(A.steps(numbered, typed), "place"), by_number(A.figure_regions(numbered, typed), "region")


def test_documents_without_headings_are_one_section(spark):
    own, _, _ = through(spark, [("title", "Field Service Notes", 1), ("text", "Look at the wiring first.", 1), ("text", "Write down all codes.", 2)], [(None, [["a"]])])
    assert [(r.section_no, r.title, r.page_from, r.page_to) for r in own] == [(0, "Field Service Notes", 1, 2)]
    assert own[0].content == "Look at the wiring first.\n\nWrite down all codes.\n\n| a |\n| --- |\n|  |"
    own, _, _ = through(spark, [("text", "Nothing else.", None)])
    assert [(r.title, r.page_from) for r in own] == [("1", None)]


def test_operational_sections_have_ordered_steps(spark):
    lines = [
        ("title", "Lockout", 1), ("section_header", "Standard Operating Procedure", 1), ("list_item", "1. Switch the unit off.", 1), ("list_item", "2. Measure the voltage.", 1),
        ("section_header", "Inspection Checklist", 2), ("list_item", "- [ ] The panel is dry.", 2), ("list_item", "• All lugs are tight.", 2), ("text", "no step", 2),
        ("section_header", "Commissioning", 3), ("text", "Step 4: Switch the power on.\nthen wait\nStep 0: Again.", 3),
    ]
    own, steps, _ = through(spark, lines, kind="SOP", doc_class="operational")
    assert [r.section_type for r in own] == ["sop", "checklist", "commissioning"]
    assert [(s.section_no, s.step_no, s.body, s.page) for s in steps] == [
        (1, 1, "Switch the unit off.", 1), (1, 2, "Measure the voltage.", 1), (2, 1, "The panel is dry.", 2), (2, 2, "All lugs are tight.", 2), (3, 4, "Switch the power on.", 3), (3, 5, "Again.", 3),
    ]


def test_lines_are_steps_only_where_none_has_a_number(spark):
    lines = [("section_header", "Commissioning", 1), ("text", "Open it.", 1), ("text", "Close it.", 1), ("section_header", "Safety", 2), ("text", "Take care.", 2)]
    _, steps, _ = through(spark, lines, kind="SOP", doc_class="operational")
    assert [(s.section_no, s.step_no, s.body) for s in steps] == [(1, 1, "Open it."), (1, 2, "Close it.")]


def test_drawings_have_figure_regions_with_callouts(spark):
    lines = [("title", "Bulletin", 1), ("section_header", "Addendum B", 1), ("text", "New torque.", 1), ("section_header", "Wiring Diagram", 2), ("text", "A1. Before", 2), ("text", "Figure 7 Wiring", 3), ("text", "A: Line in\nnot a callout\nB: Relay", 3)]
    own, _, figures = through(spark, lines, kind="Service Bulletin")
    assert [r.section_type for r in own] == ["addendum", "wiring"]
    assert [(f.label, f.page, f.callouts) for f in figures] == [("Wiring Diagram", 2, ["A1. Before"]), ("Figure 7 Wiring", 3, ["A: Line in", "B: Relay"])]


def test_page_headers_open_nothing_and_preambles_hold_their_tables(spark):
    lines = [("title", "Notes", 1), ("page_header", "Notes", 1), ("text", "Read this.", 1), ("subtitle", "Installation", 2), ("text", "Mount it.", 2)]
    own, _, _ = through(spark, lines, [(1, [["Item", "Value"], ["Torque"]]), (2, [["Bolt"]]), (None, [["lost"]])])
    assert [r.title for r in own] == ["Notes", "Installation"]
    assert own[0].content == "Read this.\n\n| Item | Value |\n| --- | --- |\n| Torque |  |"
    assert own[1].content.startswith("## Installation\n\nMount it.\n\n| Bolt |")


def test_paths_like_a_stack(spark):
    import random

    rng = random.Random(4)
    rows = [(d, i, rng.randint(1, 6), f"t{i}") for d in range(5) for i in range(40)]
    want = {}
    for d in range(5):
        stack = []
        for doc, i, level, text in rows:
            if doc == d:
                while stack and stack[-1][1] >= level:
                    stack.pop()
                want[d, i] = (stack[-1][0] if stack else None, [t for *_, t in stack] + [text])
                stack.append((i, level, text))
    got = A.heading_paths(spark.createDataFrame(rows, "doc_id long, idx long, level long, text string"))
    assert {(r.doc_id, r.idx): (r.parent_idx, r.path) for r in got.collect()} == want


def test_headings_of_forty_levels(spark):
    """Paths and depths against a stack; labels in any case, blank titles are none."""
    import random

    from lodestack.operators import sectioning

    rng = random.Random(8)
    rows = [(d, i, rng.randint(1, 40) if d else i + 1, f"h{i}") for d in range(3) for i in range(40)]
    got = {(r.doc_id, r.idx): (r.parent_idx, list(r.path)) for r in sectioning.heading_paths(spark.createDataFrame(rows, "doc_id long, idx long, level long, text string")).collect()}
    deepest = {}
    for d in range(3):
        stack = []
        for _, i, level, text in (r for r in rows if r[0] == d):
            while stack and stack[-1][1] >= level:
                stack.pop()
            assert got[d, i] == (stack[-1][0] if stack else None, [t for _, _, t in stack] + [text])
            stack.append((i, level, text))
            deepest[d] = max(deepest.get(d, 0), len(stack))
    assert deepest[0] == 40
    paths = sectioning.heading_paths(spark.createDataFrame(rows, "doc_id long, idx long, level long, text string"))
    assert {r.doc_id: r.depth for r in sectioning.heading_depths(paths).collect()} == deepest
    items = spark.createDataFrame([(1, 0, "TITLE", " T "), (1, 1, "Section_Header", " "), (1, 2, "text", "x"), (1, 3, "subtitle", "S")], "doc_id long, idx long, label string, text string")
    assert [tuple(r) for r in sectioning.labelled_headings(items).sort("idx").collect()] == [(1, 0, 1, "T"), (1, 3, 2, "S")]


def test_cells_of_tables_are_stripped_and_kept(spark):
    from pyspark.sql import functions as F

    from lodestack.operators.publishing import table_markdown

    df = spark.createDataFrame([([[" a ", "b\t"], ["1"], [None, " 2"]],)], "data array<array<string>>")
    assert df.select(table_markdown(F.col("data"))).first()[0] == "| a | b |\n| --- | --- |\n| 1 |  |\n| None | 2 |"


def test_long_numbers_are_step_numbers(spark):
    """As far as 64 bits go; greater ones count on from the step before."""
    lines = [("section_header", "Standard Operating Procedure", 1), ("text", "4086284905736939 Switch off.\n99999999999999999999 Wait.", 1)]
    _, steps, _ = through(spark, lines, kind="SOP", doc_class="operational")
    assert [(s.step_no, s.body) for s in steps] == [(4086284905736939, "Switch off."), (4086284905736940, "Wait.")]
