"""A neutral task over the synthetic documents: licence notices and fillers that do occur there."""

from __future__ import annotations

from tessella.plans.tasks import CONTEXT, NEGATION, EvidenceGroup, ExtractionTask, SchemaField

TASK = ExtractionTask(
    name="corpus_notices",
    description="Licence notices in documents.",
    fields=(
        SchemaField("licensed", "boolean", True, default=False),
        SchemaField("licence_kind", "enum", enum=("none", "mit", "apache", "gnu"), default="none"),
    ),
    evidence_groups=(
        EvidenceGroup("licence", ("mit license", "apache license", "general public license", "license", "licensed")),
        EvidenceGroup("tone", ("worthless", "pathetic", "idiot"), CONTEXT),
        EvidenceGroup("denial", ("nicht", "not licensed"), NEGATION),
    ),
    section_markers=(("Licensed under", "notice"), ("This work is", "work")),
    negation_patterns=((r"\bwithout\b.{0,20}?\blicense\b", "without_license"),),
    consistency_rules=(
        {"type": "conditional_set", "if": {"licensed": False}, "set": {"licence_kind": "none"}},
        {"type": "requires", "if": {"licensed": True}, "then_required": ["licence_kind"]},
    ),
)
