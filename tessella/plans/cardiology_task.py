"""Cardiology task: nine variables of one patient, each with its own call, text source and phrases.

Field names, phrases, patterns, markers and value maps are fixed values of the task.
"""

from __future__ import annotations

from tessella.plans.tasks import NEGATION, EvidenceGroup, ExtractionTask, SchemaField, VariableSpec

# What the answers may be, and other spellings of them.
YES_NO = ("Nein", "Ja", "Unbekannt")
YES_NO_MAP = {
    "No": "Nein", "Yes": "Ja", "Unknown": "Unbekannt", "None": "Nein", "Keine": "Nein",
    "Superficial": "Ja", "Oberflächlich": "Ja", "Oberflaechlich": "Ja", "Deep": "Ja", "Tief": "Ja",
}
EVENT = ("Keine", "TIA", "Schlaganfall", "Unbekannt")
EVENT_MAP = {
    "None": "Keine", "Nein": "Keine", "No": "Keine", "TIA": "TIA", "Transient ischemic attack": "TIA", "Stroke": "Schlaganfall",
    "Hirnschlag": "Schlaganfall", "Apoplex": "Schlaganfall", "CVI": "Schlaganfall", "Unknown": "Unbekannt", "Unbekannt": "Unbekannt",
}

# Phrases of each group.
GROUPS = (
    EvidenceGroup("schrittmacher", (
        "schrittmacher", "herzschrittmacher", "sm-implantation", "sm implantation", "schrittmacherimplantation", "schrittmacher-implantation",
        "icd-implantation", "icd implantation", "crt-d", "crt-p", "aggregatwechsel", "permanenter schrittmacher", "neuer schrittmacher",
    ), priority=1),
    EvidenceGroup("vorhofflimmern", (
        "vorhofflimmern", "vorhofflattern", "vhf", "postoperatives vorhofflimmern", "neues vorhofflimmern", "erstmaliges vorhofflimmern",
        "neu aufgetretenes vorhofflimmern",
    ), priority=1),
    EvidenceGroup("cva", (
        "schlaganfall", "hirnschlag", "apoplex", "apoplexie", "tia", "transitorische ischämische attacke", "transitorische ischaemische attacke",
        "zerebrovaskulär", "cerebrovaskulär", "cvi", "insult", "hirninfarkt", "hirnblutung", "intrazerebrale blutung",
    ), priority=1),
    EvidenceGroup("reeingriff", (
        "re-operation", "reoperation", "reeingriff", "re-eingriff", "revisionseingriff", "revisionsoperation", "revisions-operation",
        "erneute operation", "nochmalige operation", "rethorakotomie", "re-thorakotomie", "resternotomie", "re-sternotomie",
        "nachblutung revision", "tamponade revision", "wundrevision", "wund-revision", "secondlook", "second-look", "second look",
        "verschluss thorakotomie", "thorakotomie", "débridement", "debridement", "débridément", "revision wegen", "chirurgische revision",
    ), priority=1),
    EvidenceGroup("multi_organ", (
        "multiorganversagen", "multi-organ-versagen", "mehrorganversagen", "mov", "mods", "systemisches organversagen", "organversagen",
        "septischer schock", "distributiver schock",
    ), priority=1),
    EvidenceGroup("rethorakotomie", (
        "rethorakotomie", "re-thorakotomie", "re thoracotomie", "erneute thorakotomie", "secondlook thorakotomie", "revision thorakotomie",
    ), priority=1),
    EvidenceGroup("leberzirrhose", (
        "leberzirrhose", "lebercirrhose", "zirrhose", "cirrhose", "child-pugh", "child pugh", "leberinsuffizienz", "chronische lebererkrankung",
    ), priority=1),
    EvidenceGroup("verneinung", (
        "kein reeingriff", "kein re-eingriff", "keine revision", "kein revisionseingriff", "ohne revision", "keine reoperation",
        "keine re-operation", "kein schrittmacher", "kein vorhofflimmern", "kein schlaganfall", "keine tia", "keine zirrhose", "keine leberzirrhose",
    ), NEGATION, 3),
)

# Patterns on the matching view, and section markers.
NEGATIONS = (
    (r"\bkein(?:e|en)?\b.{0,30}?\brevision", "keine_revision"),
    (r"\bkein(?:e|en)?\b.{0,30}?\bre-?operation", "keine_reoperation"),
    (r"\bkein(?:e|en)?\b.{0,30}?\breeingriff", "kein_reeingriff"),
    (r"\bohne\b.{0,30}?\brevision", "ohne_revision"),
    (r"\bkein(?:e|en)?\b.{0,40}?\bschrittmacher", "kein_schrittmacher"),
    (r"\bkein(?:e|en)?\b.{0,40}?\bvorhofflimmern", "kein_vhf"),
    (r"\bkein(?:e|en)?\b.{0,40}?\bschlaganfall", "kein_schlaganfall"),
    (r"\bkein(?:e|en)?\b.{0,40}?\bzirrhose", "keine_zirrhose"),
)
MARKERS = tuple((f"[{m}]", m.lower()) for m in ("Diagnoseliste", "Verlegungsbericht", "diag", "epikrise", "jetziges_leiden", "prozedere"))

AUDIT = (
    SchemaField("information_sufficient", "boolean", True, default=False, description="true, wenn der Text für dieses Feld genügt."),
    SchemaField("reasoning", "string", True, default="", description="Begründung auf Deutsch."),
    SchemaField("evidence_quotes", "array", True, default=[], description="Wörtliche Zitate als Belege."),
)

# name, label, groups besides the negations, text source
_VARIABLES = (
    ("new_permanent_pacemaker", "Neuer permanenter Schrittmacher", ("schrittmacher",), "verlegung"),
    ("postop_atrial_fibrillation", "Postoperatives Vorhofflimmern", ("vorhofflimmern",), "both"),
    ("cerebrovascular_event", "Zerebrovaskuläres Ereignis", ("cva",), "both"),
    ("reoperation_required", "Re-Operation erforderlich", ("reeingriff",), "both"),
    ("reoperation_context", "Re-Operation Kontext", ("reeingriff",), "both"),
    ("multi_system_failure", "Multi-Organ-Versagen", ("multi_organ",), "verlegung"),
    ("rethoracotomy", "Re-Thorakotomie", ("rethorakotomie", "reeingriff"), "verlegung"),
    ("rethoracotomy_context", "Re-Thorakotomie Kontext", ("rethorakotomie", "reeingriff"), "verlegung"),
    ("liver_cirrhosis", "Leberzirrhose", ("leberzirrhose",), "both"),
)


def _field(name: str, label: str) -> SchemaField:
    if name.endswith("_context"):
        return SchemaField(name, "string", True, default="", description=f"{label}: Freitext.")
    if name == "cerebrovascular_event":
        return SchemaField(name, "enum", True, EVENT, "Keine", f"{label}; ein Verdacht allein ist Unbekannt.")
    return SchemaField(name, "enum", True, YES_NO, "Unbekannt", f"{label} (Nein, Ja, Unbekannt).")


def _maps(field: SchemaField) -> tuple[dict, ...]:
    return ({"type": "normalize", "field": field.name, "map": EVENT_MAP if field.enum == EVENT else YES_NO_MAP},) if field.type == "enum" else ()


def _variable(name: str, label: str, groups: tuple[str, ...], source: str) -> VariableSpec:
    field = _field(name, label)
    needs = {"type": "requires", "if": {"information_sufficient": True}, "then_required": ["reasoning", name]}
    return VariableSpec(name, label, f"cardiology_{name}", (field, *AUDIT), (*groups, "verneinung"), (*_maps(field), needs), source)


VARIABLES = tuple(_variable(*x) for x in _VARIABLES)
_FIELDS = tuple(v.fields[0] for v in VARIABLES)

TASK = ExtractionTask(
    name="cardiology_smoke",
    description="Kardiologie: Diagnoseliste und letzter Verlegungsbericht, eine Zeile je Patient.",
    language="de",
    send_full_text_when_no_evidence=True,
    fields=(*_FIELDS, *AUDIT),
    evidence_groups=GROUPS,
    section_markers=MARKERS,
    negation_patterns=NEGATIONS,
    consistency_rules=(
        *(rule for f in _FIELDS for rule in _maps(f)),
        {"type": "requires", "if": {"information_sufficient": True}, "then_required": ["reasoning", *(f.name for f in _FIELDS if f.type == "enum")]},
    ),
    variables=VARIABLES,
)
