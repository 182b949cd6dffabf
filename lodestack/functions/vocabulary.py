"""The vocabularies that rules refer to."""

from __future__ import annotations

# Classes of documents.
DOCUMENT_CLASSES = ("authoritative-technical", "operational", "contextual")

# Canonical document types.
DOCUMENT_TYPES = (
    "installation-manual", "operation-manual", "service-manual", "startup-procedure", "shutdown-procedure", "winterization-procedure", "pm-procedure", "sop", "checklist",
    "datasheet", "specification-sheet", "selection-guide", "certification", "service-bulletin", "revision-history", "firmware-release-note", "supersession-notice", "parts-list",
    "bom", "spare-parts-catalog", "engineering-drawing", "wiring-diagram", "pid", "safety-procedure", "loto-sheet", "permit-reference", "field-form", "inspection-template",
    "commissioning-sheet", "training-material", "technician-reference", "best-practice", "bulletin", "addendum", "quick-start", "supplemental-guide",
)

# Titles that older manifests use for types.
LEGACY_DOCUMENT_TYPES = (
    "Installation Manual", "Operation Manual", "Service Manual", "Startup Procedure", "Shutdown Procedure", "Winterization Procedure", "PM Procedure", "SOP", "Checklist",
    "Datasheet", "Specification Sheet", "Selection Guide", "Certification", "Service Bulletin", "Revision History", "Firmware Release Note", "Supersession Notice", "Parts List",
    "BOM", "Spare Parts Catalog", "Engineering Drawing", "Wiring Diagram", "P&ID", "Safety Procedure", "LOTO Sheet", "Permit Reference", "Field Form", "Inspection Template",
    "Commissioning Sheet", "Training Material", "Technician Reference", "Best Practice", "Bulletin", "Addendum", "Quick Start", "Quick Start Guide", "Supplemental Guide",
)

# Bucket dimensions, in order.
BUCKET_DIMENSIONS = ("manufacturer", "product_family", "model_applicability", "document_type", "document_class", "curated_bucket", "revision_authority", "publication_date")

# Levels of authority by document type (8 for all others and for contextual documents).
PRECEDENCE_LEVELS = {
    1: ("service-bulletin", "bulletin", "addendum"),
    2: ("installation-manual", "operation-manual", "service-manual"),  # 3 for an original edition
    4: ("datasheet", "specification-sheet", "selection-guide", "certification"),
    5: ("startup-procedure", "shutdown-procedure", "winterization-procedure", "pm-procedure", "sop", "checklist", "safety-procedure", "loto-sheet", "permit-reference", "field-form", "inspection-template", "commissioning-sheet", "best-practice"),
    6: ("quick-start", "supplemental-guide"),
    7: ("training-material", "technician-reference"),
}

# What is extracted from each type of section.
RECORD_TYPES = {
    "safety": ("warning",),
    "installation": ("procedure", "warning"),
    "configuration": ("procedure", "warning"),
    "startup": ("procedure", "warning"),
    "shutdown": ("procedure", "warning"),
    "maintenance": ("procedure", "warning"),
    "troubleshooting": ("troubleshooting_entry", "alarm_definition"),
    "specifications": ("spec_value",),
    "parts": ("part_reference",),
    "revision_notes": ("revision_note",),
    "workflow": ("procedure", "warning"),
    "sop": ("procedure", "warning"),
    "checklist": ("procedure", "warning"),
    "inspection": ("procedure", "warning"),
    "commissioning": ("procedure", "warning"),
    "wiring": ("applicability",),
    "drawing": ("applicability",),
    "diagram": ("applicability",),
    "addendum": ("revision_note", "applicability"),
    "bulletin": ("revision_note", "applicability"),
    "seasonal-procedure": ("procedure", "warning"),
    "other": ("applicability",),
}

# Keywords of section types in documents of each kind, in the order they are tried.
MANUAL_KEYWORDS = (
    ("revision_notes", ("revision", "change log", "changelog", "release note", "amendment", "history")),
    ("troubleshooting", ("troubleshooting", "diagnostic", "fault", "alarm", "error code", "problem", "led", "indicator", "status", "monitoring")),
    ("specifications", ("specification", "specifications", "technical data", "ratings", "dimensions", "electrical", "attribute", "service return")),
    ("maintenance", ("maintenance", "inspection", "cleaning", "lubrication", "replacement", "replace", "battery")),
    ("installation", ("installation", "mounting", "wiring", "setup", "preparation", "install", "adding", "connect", "connection", "grounding", "ground", "bonding", "bond", "route", "cable")),
    ("configuration", (
        "configuration", "config", "parameter", "programming", "settings", "commissioning", "configure", "command line interface", "driver", "properties", "address", "assign",
        "define", "select", "enable", "disable", "vlan", "dhcp", "communication", "message", "tag", "project", "cli", "webui", "device manager", "rslinx", "ring supervisor",
        "ring participant", "redundant gateway",
    )),
    ("startup", ("startup", "start up", "start-up", "initial start", "power on", "getting started", "power up")),
    ("shutdown", ("shutdown", "shut down", "stop procedure", "power off", "decommission")),
    ("safety", ("safety", "warning", "caution", "danger", "hazard", "precaution", "attention", "important user information", "explosion hazard", "shock hazard", "burn hazard")),
    ("parts", ("parts", "spare part", "replacement part", "bill of materials", "bom", "catalog number")),
)
OPERATIONAL_KEYWORDS = (
    ("seasonal-procedure", ("winterization", "seasonal procedure", "season startup", "spring startup", "summer startup")),
    ("sop", ("standard operating procedure", "sop")),
    ("checklist", ("checklist", "check list", "verification list", "task list")),
    ("inspection", ("inspection", "inspection sheet", "inspection template", "inspection form")),
    ("commissioning", ("commissioning", "commissioning checklist", "commissioning sheet", "acceptance test")),
    ("workflow", ("workflow", "procedure", "process", "sequence of operation", "method")),
)
DRAWING_KEYWORDS = (
    ("wiring", ("wiring diagram", "terminal wiring", "wiring", "connection diagram", "terminal layout")),
    ("drawing", ("engineering drawing", "mechanical drawing", "drawing", "layout")),
    ("diagram", ("diagram", "schematic", "figure", "illustration", "p&id", "pid")),
)
BULLETIN_KEYWORDS = (
    ("addendum", ("addendum", "supplement", "supplemental", "appendix update")),
    ("bulletin", ("service bulletin", "bulletin", "field notice", "notice", "advisory")),
    ("revision_notes", ("revision", "release note", "change log", "history", "supersession")),
)
#: The orders in which the four lists are tried, by the context of a document.
CONTEXT_ORDERS = {
    "operational": ("operational", "drawing", "bulletin", "manual"),
    "drawing": ("drawing", "operational", "bulletin", "manual"),
    "bulletin": ("bulletin", "drawing", "operational", "manual"),
    "manual": ("manual", "operational", "bulletin", "drawing"),
}
# Document types of the contexts (all others are manuals).
CONTEXT_TYPES = {
    "operational": ("sop", "checklist", "startup-procedure", "shutdown-procedure", "winterization-procedure", "pm-procedure", "inspection-template", "commissioning-sheet", "best-practice", "safety-procedure"),
    "drawing": ("engineering-drawing", "wiring-diagram", "pid"),
    "bulletin": ("service-bulletin", "bulletin", "addendum", "supplemental-guide", "supersession-notice"),
}
# Section types that documents of a type have by default.
DEFAULT_SECTION_TYPES = {
    "startup-procedure": "workflow", "shutdown-procedure": "workflow", "winterization-procedure": "seasonal-procedure", "pm-procedure": "workflow", "sop": "sop", "checklist": "checklist",
    "service-bulletin": "bulletin", "bulletin": "bulletin", "addendum": "addendum", "engineering-drawing": "drawing", "wiring-diagram": "wiring", "pid": "diagram",
    "inspection-template": "inspection", "commissioning-sheet": "commissioning", "best-practice": "workflow", "safety-procedure": "workflow",
}
# Titles that make a section one of safety.
ADMONITIONS = ("attention", "important", "warning", "caution", "danger", "hazard", "explosion hazard", "shock hazard", "burn hazard", "important user information")
# Headings carried over from other pages, which say nothing.
CARRYOVER_TITLES = ("attention", "caution", "continued", "danger", "hazard", "important", "important user information", "notes", "notes:", "tip", "warning")
