import json

import pytest
from pyspark.sql import functions as F

from tessella.functions import jsonx as J
from tessella.functions import rules
from tessella.plans.tasks import ExtractionTask, SchemaField, load_task

TASK = ExtractionTask(name="t", fields=(
    SchemaField("flag", "boolean", True, default=False), SchemaField("grade", "enum", enum=("none", "mild", "severe"), default="none"),
    SchemaField("count", "integer"), SchemaField("score", "number"), SchemaField("note", "string", default=""), SchemaField("tags", "array", default=[]),
))
ANSWERS = [
    '{"a": 1}', '```json\n{"a": 1}\n```', 'Sure! {"a": 1} Done.', '<start_of_turn>model\n{"a": 1,}<end_of_turn>', '{"a": "}{"} tail', '[{"a": 1}, {"b": 2}]',
    '<think>{}</think>{"a": 1}', '{"a": NaN}', "", None, "   ", "no json", '{"a": ', '{"a": [1, 2,],}', "{'a': 1}",
]


def test_parse_answers_in_both_forms(spark):
    plain = []
    for raw in ANSWERS:
        try:
            plain.append(J.parse_answer(raw))
        except ValueError:
            plain.append(None)
    assert plain[:7] == [{"a": 1}] * 4 + [{"a": "}{"}, {"a": 1}, {}]
    assert plain[8:13] == [None] * 5 and plain[13] == {"a": [1, 2]} and plain[14] is None
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ANSWERS)], "i int, v string").orderBy("i")
    got = [r[0] for r in df.select(J.parse_answer_column(F.col("v"))).collect()]
    for k, (a, b) in enumerate(zip(got, plain)):
        if k not in (4, 7):  # trailing text after an object and NaN go different ways to the same object
            assert (None if a is None else json.loads(a)) == b
    assert json.loads(got[4].rpartition("}")[0] + "}" if got[4].endswith("tail") else got[4]) == {"a": "}{"}


def test_first_object():
    assert J.first_object('x {"a": {"b": "}"}} y') == '{"a": {"b": "}"}}'
    assert J.first_object(None) == "" and J.first_object(" plain ") == "plain" and J.first_object('{"a": ') == '{"a":'


@pytest.mark.parametrize("raw,want,errors", [
    ({"flag": "ja", "grade": "SEVERE", "count": "3", "score": "1.5", "note": " hi ", "tags": [" a ", "", 2]}, (True, "severe", 3, 1.5, "hi", ["a", "2"]), 0),
    ({"flag": 0, "grade": "odd", "count": "3.7", "score": "x", "tags": "one"}, (False, "none", 3, None, "", ["one"]), 2),
    ({"count": "inf", "extra": 1}, (False, "none", None, None, "", []), 2), ({}, (False, "none", None, None, "", []), 1),
])
def test_validate_in_both_forms(spark, raw, want, errors):
    fields, said = J.validate(raw, TASK)
    assert tuple(fields.values()) == want and len(said) == errors
    struct, found = J.validate_column(F.lit(json.dumps(raw)), TASK)
    row = spark.range(1).select(struct.alias("f"), found.alias("e")).first()
    assert tuple(row["f"]) == want and len(row["e"]) == errors


def test_normalize_raw_before_validation():
    task = load_task("cardiology_smoke").for_variable(load_task("cardiology_smoke").variables[0])
    assert J.normalize_raw({"new_permanent_pacemaker": " YES "}, task.consistency_rules)["new_permanent_pacemaker"] == "Ja"


def test_quotes_one_hot_and_cells(spark):
    df = spark.createDataFrame([(["a", " b", "", "a "], ["b", "c"], "x y;")], "p array<string>, q array<string>, e string")
    task = ExtractionTask(name="t", fields=(SchemaField("e", "enum", enum=("x y;", "z")),))
    row = df.select(J.merge_quotes(F.col("p"), F.col("q"), F.lit(None)).alias("m"), *J.one_hot(task), J.bool_cell(F.lit(None).cast("boolean")).alias("b"), J.join_cell(F.col("q")).alias("j")).first()
    assert row["m"] == ["a", " b", "c"] and row["e__x_y"] == 1 and row["e__z"] == 0 and row["b"] == "False" and row["j"] == "b | c"


GUARD = ExtractionTask(name="g", fields=(
    SchemaField("present", "boolean"), SchemaField("negated", "boolean"), SchemaField("a", "boolean"), SchemaField("b", "boolean"), SchemaField("grade", "enum", enum=("none", "mild")), SchemaField("note"),
), consistency_rules=(
    {"type": "conditional_set", "if": {"negated": True}, "set": {"present": False}}, {"type": "conditional_set", "if": {"present": False}, "set": {"grade": "none"}},
    {"type": "normalize", "field": "grade", "map": {"slight": "mild"}}, {"type": "mutually_exclusive", "fields": ["a", "b"]},
    {"type": "requires", "if": {"present": True}, "then_required": ["note"]}, {"type": "impossible_combination", "when": {"present": True, "negated": True}}, {"type": "odd"},
))


def guarded(spark, **values):
    kinds = {f.name: f.spark().dataType for f in GUARD.fields}
    final, report = rules.apply_rules(GUARD, {n: F.lit(values.get(n)).cast(k) for n, k in kinds.items()})
    row = spark.range(1).select(F.struct(*[final[n].alias(n) for n in kinds]).alias("f"), F.struct(*[c.alias(n) for n, c in report.items()]).alias("r")).first()
    return row["f"].asDict(), row["r"].asDict()


def test_detections_read_the_original(spark):
    f, r = guarded(spark, present=True, negated=True, grade="mild", note="n")
    assert f["present"] is False and f["grade"] == "none"
    assert r["contradictions"] == ["impossible_combination: {'present': True, 'negated': True}", "unknown_rule_type: odd"]
    assert r["normalized_fields"] == ["present: True -> False (conditional_set)", "grade: 'mild' -> 'none' (conditional_set)"]
    assert r["applied_rules"] == ["conditional_set", "conditional_set", "normalize", "mutually_exclusive", "requires", "impossible_combination"] and r["manual_review_candidate"]


def test_requires_exclusive_normalize_and_null_as_false(spark):
    f, r = guarded(spark, present=True, a=True, b=True, grade="Slight")
    assert f["grade"] == "mild" and r["missing_dependent_fields"] == ["'note' required when {'present': True}"]
    assert "mutually_exclusive violated: ['a', 'b'] are all true" in r["contradictions"] and r["normalized_fields"] == ["grade: 'Slight' -> 'mild'"]
    f, r = guarded(spark, grade="mild")  # present is null, which equals False
    assert f["grade"] == "none"
