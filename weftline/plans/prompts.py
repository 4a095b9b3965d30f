"""Prompt profiles and prompts, rendered as expressions."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.plain import call_partitions  # noqa: F401  (for callers that plan calls)

DEFAULT_PROFILE = Path(__file__).with_name("default_profile.toml")

# The rules that every question gets, whatever its profile.
ANSWER_RULES = """

Additional output rules:
1. Keep the provider's native reasoning style if reasoning is produced; do not add a second reasoning block or rewrite the format.
2. If reasoning is produced, keep it very short and only include the key basis for choosing the correct option.
3. Do not repeat or paraphrase the question.
4. Do not restate or enumerate all choices unless absolutely necessary.
5. Do not include hesitation, self-dialogue, meta-commentary, or format self-checks.
6. Do not output phrases like "The answer is F", "Final answer", or "答案是F".
7. Do not use formatting like \\boxed{F}.
8. The final answer must end with exactly one uppercase option letter only, such as F.
9. Do not output any extra explanation after the final option letter.
10. Bad style examples that must not appear:
- "First, let me analyze this question"
- "Now I will check each option"
- "The question is asking about..."
- "Therefore, the final answer is F"

Return the answer in the provider's native format, with concise reasoning if any, and end with a single uppercase option letter."""
FEEDBACK_BEFORE, FEEDBACK_AFTER = "\n上一轮输出未通过，主要原因：\n", "\n请仅修复这些问题后重新输出。\n"


@dataclass(frozen=True)
class Profile:
    name: str
    generation: str
    validation: str | None


def load_profile(path: str | None = None, validate: bool = True) -> Profile:
    """A profile file (TOML); without a path our own. Unknown keys, blank names and missing templates are refused."""
    with open(path or DEFAULT_PROFILE, "rb") as f:
        raw = tomllib.load(f)
    if not set(raw) <= {"name", "generation", "validation"} or any(set(raw[k]) - {"template"} for k in ("generation", "validation") if k in raw):
        raise ValueError("unknown keys in a prompt profile")
    name, generation = raw.get("name", "").strip(), raw.get("generation", {}).get("template", "").strip()
    validation = raw.get("validation", {}).get("template", "").strip() or None
    if not name or not generation:
        raise ValueError("a prompt profile needs a name and a generation template")
    if validate and not validation:
        raise ValueError("validation is on, but the prompt profile has no validation template")
    return Profile(name, generation, validation)


def render(template: str, values: dict[str, Column]) -> Column:
    """Replace {{name}} by values, one name after the other (a later name inside an earlier value is replaced too)."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), value)
    return out


def feedback_block(feedback: Column) -> Column:
    return F.coalesce(F.concat(F.lit(FEEDBACK_BEFORE), feedback, F.lit(FEEDBACK_AFTER)), F.lit(""))


def quoted(c: Column) -> Column:
    """A JSON string literal."""
    inner = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)\A\{"v":(".*")\}\z', 1)
    return F.when(c.isNull(), F.lit("null")).otherwise(inner)


def source_json(sample_id: Column, user: Column, meta: Column) -> Column:
    return F.concat(F.lit('{\n  "meta": '), meta, F.lit(',\n  "sample_id": '), quoted(sample_id), F.lit(',\n  "user": '), quoted(user), F.lit("\n}"))


def accepted_json(users: Column) -> Column:
    """users: an ordered array of strings."""
    items = F.transform(users, lambda u: F.concat(F.lit('  {\n    "user": '), quoted(u), F.lit("\n  }")))
    return F.when(F.size(users) == 0, "[]").otherwise(F.concat(F.lit("[\n"), F.array_join(items, ",\n"), F.lit("\n]")))


def candidates_json(items: Column) -> Column:
    """items: an ordered array of structs index, user, answer, meta."""
    one = lambda i: F.concat(F.lit('  {\n    "answer": '), quoted(i["answer"]), F.lit(',\n    "index": '), i["index"].cast("string"), F.lit(',\n    "meta": '), F.coalesce(i["meta"], F.lit("null")), F.lit(',\n    "user": '), quoted(i["user"]), F.lit("\n  }"))
    return F.concat(F.lit("[\n"), F.array_join(F.transform(items, one), ",\n"), F.lit("\n]"))


def generation_prompt(profile: Profile, count: Column, source: Column, accepted: Column, feedback: Column) -> Column:
    values = {"profile_name": F.lit(profile.name), "variant_count": count.cast("string"), "source_sample_json": source, "accepted_samples_json": accepted, "feedback_block": feedback_block(feedback)}
    return render(profile.generation, values)


def validation_prompt(profile: Profile, source: Column, candidates: Column) -> Column:
    if profile.validation is None:
        raise ValueError(f"prompt profile {profile.name} has no validation template")
    return render(profile.validation, {"profile_name": F.lit(profile.name), "source_sample_json": source, "generated_candidates_json": candidates})


def answer_prompt(user: Column, rules: str = ANSWER_RULES) -> Column:
    return F.concat(user, F.lit(rules))
