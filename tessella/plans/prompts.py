"""Prompts, built at plan time: a task's instruction and the description of its schema."""

from __future__ import annotations

from functools import lru_cache

from tessella.plans.tasks import ExtractionTask

_GENERAL = {
    "de": "Du liest klinische Berichte und füllst Felder aus. Stütze dich nur auf den gegebenen Text; ein Verdacht ist kein Beleg.",
    "en": "You read reports and fill in fields. Rely on the given text alone; a suspicion is no proof.",
}
#: prompt name -> instruction; names that are not here have the general one with the task's description
TEMPLATES: dict[str, str] = {
    "demo_extraction": _GENERAL["de"] + "\nThema: Fieber. Verneintes Fieber ist nicht vorhandenes Fieber.",
}
_LABELS = {
    "de": ("Antworte nur mit einem JSON-Objekt mit genau diesen Feldern:", "pflicht", "eines von", "Standard", "Keine weiteren Felder, kein Text ausserhalb des JSON; Freitext auf Deutsch."),
    "en": ("Answer with one JSON object of exactly these fields:", "required", "one of", "default", "No other fields, no text outside the JSON."),
}


@lru_cache(maxsize=64)
def load_prompt(name: str) -> str:
    """The instruction of that name; FileNotFoundError if there is none."""
    if name not in TEMPLATES:
        raise FileNotFoundError(f"no prompt named {name!r}")
    return TEMPLATES[name]


def render_schema_block(task: ExtractionTask) -> str:
    head, required, one_of, default, tail = _LABELS["de" if task.german else "en"]
    lines = [head]
    for f in task.fields:
        notes = [required] * f.required
        notes += [f"{one_of}: {', '.join(f.enum)}"] * (f.type == "enum")
        notes += [f"{default}: {f.default}"] * (f.default is not None)
        notes += [f.description] * bool(f.description)
        lines.append(f'- "{f.name}": {f.type}' + (f" ({'; '.join(notes)})" if notes else ""))
    return "\n".join([*lines, tail])


def build_system_prompt(task: ExtractionTask) -> str:
    general = _GENERAL["de" if task.german else "en"]
    text = TEMPLATES.get(task.prompt_name) or f"{general}\n{task.description}"
    return f"{text.rstrip()}\n\n{render_schema_block(task)}\n"


def user_prompt(task: ExtractionTask, text: str) -> str:
    lead = "Text zur Extraktion; beschriftete Ausschnitte gehen vor." if task.german else "Text for extraction; labelled snippets take precedence."
    return f"{lead}\n\n{text}\n"


def retry_suffix(task: ExtractionTask, attempt: int) -> str:
    if attempt <= 0:
        return ""
    return "\n\nNur ein gültiges JSON-Objekt, sonst nichts." if task.german else "\n\nOnly one valid JSON object, nothing else."


def fallback_prefix(task: ExtractionTask, shortened: bool) -> str:
    if task.german:
        return f"Keine Ausschnitte gefunden; der bereinigte Text{' (gekürzt)' if shortened else ''}:\n\n"
    return f"No snippets were found; the cleaned text{' (shortened)' if shortened else ''}:\n\n"
