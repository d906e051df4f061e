"""Extraction tasks as pure data: schema, phrase groups, patterns, rules, variables; and their registry."""

from __future__ import annotations

import importlib
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

from pyspark.sql import types as T

POSITIVE, CONTEXT, NEGATION = "positive", "context", "negation"
ROLES = (POSITIVE, CONTEXT, NEGATION)
_SPARK = {
    "string": T.StringType(), "boolean": T.BooleanType(), "integer": T.LongType(), "number": T.DoubleType(),
    "enum": T.StringType(), "array": T.ArrayType(T.StringType()),
}
FIELD_TYPES = tuple(_SPARK)


@dataclass(frozen=True)
class SchemaField:
    name: str
    type: str = "string"
    required: bool = False
    enum: tuple[str, ...] = ()
    default: Any = None
    description: str = ""

    def __post_init__(self) -> None:
        if self.type not in FIELD_TYPES:
            raise ValueError(f"field {self.name!r} has type {self.type!r}; known are {', '.join(FIELD_TYPES)}")
        if self.type == "enum" and not self.enum:
            raise ValueError(f"field {self.name!r} is an enum without values")

    def spark(self) -> T.StructField:
        meta = {"required": self.required, "enum": list(self.enum), "default": self.default, "description": self.description}
        return T.StructField(self.name, _SPARK[self.type], True, {k: v for k, v in meta.items() if v is not None})


@dataclass(frozen=True)
class EvidenceGroup:
    name: str
    phrases: tuple[str, ...]
    role: str = POSITIVE
    priority: int = 100

    def __post_init__(self) -> None:
        if self.role not in ROLES:
            raise ValueError(f"group {self.name!r} has role {self.role!r}; known are {', '.join(ROLES)}")


@dataclass(frozen=True)
class VariableSpec:
    """A field extracted by a call of its own, from the text that ``text_source`` names."""

    name: str
    label: str
    prompt_name: str
    fields: tuple[SchemaField, ...]
    evidence_group_names: tuple[str, ...]
    consistency_rules: tuple[dict[str, Any], ...] = ()
    text_source: str = "report"


@dataclass(frozen=True)
class ExtractionTask:
    name: str
    description: str = ""
    fields: tuple[SchemaField, ...] = ()
    evidence_groups: tuple[EvidenceGroup, ...] = ()
    section_markers: tuple[tuple[str, str], ...] = ()
    negation_patterns: tuple[tuple[str, str], ...] = ()
    prompt_name: str = ""
    consistency_rules: tuple[dict[str, Any], ...] = ()
    language: str = "en"
    send_full_text_when_no_evidence: bool = False
    variables: tuple[VariableSpec, ...] = ()

    def field_by_name(self, name: str) -> SchemaField | None:
        return next((f for f in self.fields if f.name == name), None)

    def schema(self) -> T.StructType:
        return T.StructType([f.spark() for f in self.fields])

    def schema_dict(self) -> dict[str, Any]:
        keys = ("name", "type", "required", "enum", "default", "description")
        return {"task": self.name, "fields": [{k: list(f.enum) if k == "enum" else getattr(f, k) for k in keys} for f in self.fields]}

    @property
    def german(self) -> bool:
        return (self.language or "en").lower().startswith("de")

    def for_variable(self, var: VariableSpec) -> ExtractionTask:
        """The task of one variable; groups keep the order of this task."""
        return ExtractionTask(
            name=f"{self.name}:{var.name}", description=var.label or var.name, fields=var.fields,
            evidence_groups=tuple(g for g in self.evidence_groups if g.name in var.evidence_group_names),
            section_markers=self.section_markers, negation_patterns=self.negation_patterns, prompt_name=var.prompt_name,
            consistency_rules=var.consistency_rules, language=self.language,
            send_full_text_when_no_evidence=self.send_full_text_when_no_evidence,
        )


#: task name -> module with its ``TASK``
REGISTRY: dict[str, str] = {
    "demo_extraction": "tessella.plans.demo_task",
    "cardiology_smoke": "tessella.plans.cardiology_task",
    "corpus_notices": "tessella.plans.corpus_task",
}


def available_tasks() -> list[str]:
    return sorted(REGISTRY)


@lru_cache(maxsize=64)
def load_task(name: str) -> ExtractionTask:
    """The task of that name: KeyError if unknown, TypeError if its module holds something else."""
    if name not in REGISTRY:
        raise KeyError(f"unknown task {name!r}; available: {', '.join(available_tasks())}")
    task = getattr(importlib.import_module(REGISTRY[name]), "TASK", None)
    if not isinstance(task, ExtractionTask):
        raise TypeError(f"TASK of {REGISTRY[name]} is not an ExtractionTask")
    return task
