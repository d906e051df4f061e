"""Consistency rules compiled at plan time into Column expressions.

Transforming rules (``normalize``, ``conditional_set``) fold over a dict of columns in the order of
the rules, so later ones see what earlier ones set. Detecting rules (``mutually_exclusive``,
``requires``, ``impossible_combination``) read the fields as they came.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.text import strip
from tessella.plans.tasks import ExtractionTask, SchemaField

TRANSFORMS = ("normalize", "conditional_set")
DETECTIONS = ("mutually_exclusive", "requires", "impossible_combination")


class Fields:
    """Columns of a task's fields with what Python's values would do: truth, emptiness, text, repr."""

    def __init__(self, task: ExtractionTask, columns: dict[str, Column]):
        self.kind = {f.name: f for f in task.fields}
        self.columns = dict(columns)

    def _of(self, name: str) -> tuple[SchemaField | None, Column]:
        return self.kind.get(name), self.columns.get(name, F.lit(None).cast("string"))

    def truth(self, name: str) -> Column:
        field, c = self._of(name)
        kind = field.type if field else "string"
        held = c if kind == "boolean" else c != 0 if kind in ("integer", "number") else F.size(c) > 0 if kind == "array" else c != ""
        return F.coalesce(held, F.lit(False))

    def empty(self, name: str) -> Column:
        """Null, a blank string or an empty list; False and 0 are values."""
        field, c = self._of(name)
        kind = field.type if field else "string"
        if kind == "array":
            return c.isNull() | (F.size(c) == 0)
        return c.isNull() | (strip(c) == "") if kind in ("string", "enum") else c.isNull()

    def text(self, name: str) -> Column:
        field, c = self._of(name)
        shown = F.when(c, "True").otherwise("False") if field and field.type == "boolean" else F.to_json(c) if field and field.type == "array" else c.cast("string")
        return F.when(c.isNull(), "None").otherwise(shown)

    def repr(self, name: str) -> Column:
        field, c = self._of(name)
        if field is None or field.type in ("string", "enum"):
            return F.when(c.isNull(), "None").when(c.contains("'") & ~c.contains('"'), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(F.concat(F.lit("'"), c, F.lit("'")))
        return self.text(name)

    def equals(self, name: str, value: Any) -> Column:
        """Truth values if either side is boolean (so null equals False), else text without case."""
        field, _ = self._of(name)
        if isinstance(value, bool) or (field and field.type == "boolean"):
            return self.truth(name) == F.lit(bool(value))
        return F.lower(strip(self.text(name))) == F.lit(str(value).strip().lower())

    def holds(self, condition: dict[str, Any]) -> Column:
        out = F.lit(True)
        for name, value in condition.items():
            out &= self.equals(name, value)
        return out

    def literal(self, name: str, value: Any) -> Column:
        field = self.kind.get(name)
        if field and field.type == "array":
            return F.array(*[F.lit(x) for x in value or []]).cast("array<string>")
        return F.lit(value).cast(field.spark().dataType if field else "string")


def apply_rules(task: ExtractionTask, columns: dict[str, Column]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Final columns of the fields, and the report: normalized_fields, contradictions,
    missing_dependent_fields, applied_rules, manual_review_candidate."""
    first, now = Fields(task, columns), Fields(task, columns)
    notes: dict[str, list[Column]] = {"normalized_fields": [], "contradictions": [], "missing_dependent_fields": []}
    applied: list[str] = []
    for rule in task.consistency_rules:
        kind = str(rule.get("type", ""))
        if kind == "normalize":
            name = rule.get("field")
            if name in now.columns:
                key = F.lower(strip(now.text(name)))
                known = {str(k).strip().lower(): v for k, v in rule.get("map", {}).items()}
                if known:
                    new = F.try_element_at(F.create_map(*[F.lit(x) for k, v in known.items() for x in (k, str(v))]), key)
                    hit = ~now.empty(name) & new.isNotNull() & (F.lower(strip(new)) != key)
                    quoted = F.concat(F.lit("'"), strip(now.text(name)), F.lit("'"))
                    notes["normalized_fields"].append(F.when(hit, F.concat(F.lit(f"{name}: "), quoted, F.lit(" -> '"), new, F.lit("'"))))
                    kind_of = now.kind[name].spark().dataType if name in now.kind else "string"
                    now.columns[name] = F.when(hit, new.try_cast(kind_of)).otherwise(now.columns[name])
        elif kind == "conditional_set":
            holds = now.holds(rule.get("if", {}))
            for name, value in rule.get("set", {}).items():
                hit = holds & ~now.equals(name, value)
                notes["normalized_fields"].append(F.when(hit, F.concat(F.lit(f"{name}: "), now.repr(name), F.lit(f" -> {value!r} (conditional_set)"))))
                _, old = now._of(name)
                now.columns[name] = F.when(hit, now.literal(name, value)).otherwise(old)
        elif kind == "mutually_exclusive":
            names = rule.get("fields", [])
            truthy = F.array_compact(F.array(*[F.when(first.truth(n), F.lit(f"'{n}'")) for n in names])) if names else F.array().cast("array<string>")
            said = F.concat(F.lit("mutually_exclusive violated: ["), F.array_join(truthy, ", "), F.lit("] are all true"))
            notes["contradictions"].append(F.when(F.size(truthy) > 1, said))
        elif kind == "requires":
            holds = first.holds(rule.get("if", {}))
            for name in rule.get("then_required", []):
                notes["missing_dependent_fields"].append(F.when(holds & first.empty(name), F.lit(f"'{name}' required when {rule.get('if')}")))
        elif kind == "impossible_combination":
            if when := rule.get("when", {}):
                notes["contradictions"].append(F.when(first.holds(when), F.lit(f"impossible_combination: {when}")))
        else:
            notes["contradictions"].append(F.lit(f"unknown_rule_type: {kind}"))
            continue
        applied.append(kind)
    report = {k: F.array_compact(F.array(*v)) if v else F.array().cast("array<string>") for k, v in notes.items()}
    report["applied_rules"] = F.array(*[F.lit(x) for x in applied]).cast("array<string>")
    report["manual_review_candidate"] = (F.size(report["contradictions"]) > 0) | (F.size(report["missing_dependent_fields"]) > 0)
    return now.columns, report
