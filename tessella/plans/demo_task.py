"""A small example task: documentation of fever. The phrases, patterns and rules are fixed values."""

from __future__ import annotations

from tessella.plans.tasks import CONTEXT, NEGATION, EvidenceGroup, ExtractionTask, SchemaField

# Fixed values of the task: field names, phrases, markers, patterns, value maps.
TASK = ExtractionTask(
    name="demo_extraction",
    description="Beispiel: dokumentiertes Fieber in einem Bericht.",
    language="de",
    fields=(
        SchemaField("fever_present", "boolean", True, default=False, description="Fieber ist dokumentiert."),
        SchemaField("fever_grade", "enum", enum=("keine", "niedrig", "hoch"), default="keine", description="Grad des Fiebers."),
        SchemaField("fever_negated", "boolean", default=False, description="Fieber ist ausdrücklich verneint."),
        SchemaField("max_temperature_c", "number", description="Höchste Temperatur in Celsius."),
    ),
    evidence_groups=(
        EvidenceGroup("fever_terms", ("high fever", "low grade fever", "fever", "febrile", "pyrexia", "hyperthermia", "temperature"), priority=1),
        EvidenceGroup("associated_symptoms", ("chills", "rigors", "night sweats", "sweating"), CONTEXT, 2),
        EvidenceGroup("fever_negation", ("afebrile", "no fever", "without fever", "denies fever"), NEGATION, 3),
    ),
    section_markers=(("[History]", "history"), ("[Assessment]", "assessment"), ("[Plan]", "plan")),
    negation_patterns=((r"\bno\b.{0,20}?\bfever\b", "no_fever"), (r"\bwithout\b.{0,20}?\bfever\b", "without_fever")),
    prompt_name="demo_extraction",
    consistency_rules=(
        {"type": "conditional_set", "if": {"fever_negated": True}, "set": {"fever_present": False}},
        {"type": "conditional_set", "if": {"fever_present": False}, "set": {"fever_grade": "keine"}},
        {"type": "normalize", "field": "fever_grade", "map": {"none": "keine", "low_grade": "niedrig", "high_grade": "hoch"}},
        {"type": "impossible_combination", "when": {"fever_present": True, "fever_negated": True}},
        {"type": "requires", "if": {"fever_present": True}, "then_required": ["fever_grade"]},
    ),
)
