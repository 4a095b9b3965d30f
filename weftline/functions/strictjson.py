"""Strict JSON at the edges, where Spark's own parser is too lenient: Arrow batches in, typed columns out."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
#: Fields of the item and verdict envelopes (fixed names of the format).
ITEM_FIELDS, VERDICT_FIELDS = {"user", "answer", "meta"}, {"index", "valid", "reason"}


class Malformed(ValueError):
    pass


def _refuse(name: str):
    raise Malformed(f"{name} is not JSON")


class Number(str):
    """A number as it was written."""


def loads(text: str, unique: bool = False):
    """A JSON value; numbers keep their text. NaN and Infinity are refused, repeated keys too if asked."""

    def pairs(items: list) -> dict:
        if unique and len({k for k, _ in items}) != len(items):
            raise Malformed("a key is repeated")
        return dict(items)

    try:
        return json.loads(text, parse_float=Number, parse_int=Number, parse_constant=_refuse, object_pairs_hook=pairs)
    except (ValueError, RecursionError) as e:
        raise Malformed(str(e)) from None


def dumps(value, sort: bool = True) -> str:
    """Compact JSON, keys sorted; numbers as they were read."""
    if isinstance(value, Number):
        return str.__str__(value)
    if isinstance(value, dict):
        keys = sorted(value) if sort else value
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{dumps(value[k], sort)}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(dumps(v, sort) for v in value) + "]"
    return json.dumps(value, ensure_ascii=False)


def scalar(value) -> str | None:
    """Text of a string (trimmed), boolean or number; None for anything else and for blank strings."""
    if isinstance(value, bool):
        return "true" if value else "false"
    return (str(value).strip(_SPACE) or None) if isinstance(value, str) else None


def balanced_object(text: str) -> str | None:
    """The first object with balanced braces, minding strings and escapes."""
    start = text.find("{")
    if start < 0:
        return None
    depth, quoted = 0, False
    for m in re.finditer(r'\\.|["{}]', text[start:], re.S):
        sign = m[0]
        if sign == '"':
            quoted = not quoted
        elif not quoted and sign in "{}":
            depth += 1 if sign == "{" else -1
            if depth == 0:
                return text[start : start + m.end()]
    return None


def extract_object(text: str) -> str | None:
    """An object from a fenced block (each tried in turn), else from the whole text."""
    parts = text.strip(_SPACE).split("```")
    for block in parts[1::2]:
        found = balanced_object(block)
        if found is not None:
            return found
    return balanced_object(text)


def _envelope(text: str, fields: set[str], read) -> list:
    value = loads(text, unique=True)
    if not isinstance(value, dict) or set(value) != {"items"} or not isinstance(value["items"], list):
        raise Malformed("the envelope has items and nothing else")
    out = []
    for item in value["items"]:
        if not isinstance(item, dict) or not set(item) <= fields:
            raise Malformed("an item has unknown fields")
        out.append(read(item))
    return out


def _item(item: dict) -> dict:
    if not all(type(item.get(k)) is str for k in ("user", "answer")):
        raise Malformed("user and answer are strings")
    return {"user": item["user"], "answer": item["answer"], "meta": dumps(item.get("meta"))}


def _verdict(item: dict) -> dict:
    index = item.get("index")
    if not isinstance(index, Number) or not index.isdigit() or not isinstance(item.get("valid"), bool) or type(item.get("reason", "")) is not str:
        raise Malformed("index, valid and reason have their types")
    return {"index": int(index), "valid": item["valid"], "reason": item.get("reason", "")}


def _either(text: str, fields: set[str], read) -> list:
    """The whole text as an envelope, else the object found in it."""
    try:
        return _envelope(text, fields, read)
    except Malformed:
        found = extract_object(text)
        if found is None:
            raise Malformed("no object") from None
        return _envelope(found, fields, read)


def read_items(text: str | None) -> dict:
    try:
        items = _either(text or "", ITEM_FIELDS, _item)
    except Malformed as e:
        return {"items": None, "error": f"generator did not return valid JSON or extractable JSON: {e}"}
    return {"items": items, "error": None} if items else {"items": None, "error": "generator returned no items"}


def read_verdicts(text: str | None) -> dict:
    try:
        return {"items": _either(text or "", VERDICT_FIELDS, _verdict), "error": None}
    except Malformed as e:
        return {"items": None, "error": f"validator did not return valid JSON: {e}"}


def _parsed(**fields: T.DataType) -> T.StructType:
    item = T.StructType([T.StructField(n, t) for n, t in fields.items()])
    return T.StructType([T.StructField("items", T.ArrayType(item)), T.StructField("error", T.StringType())])


ITEMS_TYPE = _parsed(user=T.StringType(), answer=T.StringType(), meta=T.StringType())
VERDICTS_TYPE = _parsed(index=T.LongType(), valid=T.BooleanType(), reason=T.StringType())


@F.pandas_udf(ITEMS_TYPE)
def parse_items(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_items(t) for t in texts], columns=["items", "error"])


@F.pandas_udf(VERDICTS_TYPE)
def parse_verdicts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_verdicts(t) for t in texts], columns=["items", "error"])


@F.pandas_udf(T.StringType())
def extracted_object(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else extract_object(t))


@F.pandas_udf(T.StringType())
def structured_prompts(texts: pd.Series) -> pd.Series:
    """Of a JSON context its ``prompt``, or the prompts of its ``stages``, as a JSON array of strings; else null."""
    from weftline.functions.plain import unescape

    def prompts(text: str | None) -> str | None:
        for form in (text, unescape(text)) if text is not None else ():
            try:
                value = loads(form)
            except Malformed:
                continue
            if not isinstance(value, dict):
                return None
            if type(value.get("prompt")) is str:
                return json.dumps([value["prompt"]])
            stages = value.get("stages")
            found = [s["prompt"] for s in stages if isinstance(s, dict) and type(s.get("prompt")) is str] if isinstance(stages, list) else []
            return json.dumps(found) if found else None
        return None

    return texts.map(prompts)


#: What of an input row is looked at (fixed names); the rest is dropped at the edge.
ID_KEYS = ("task_id", "sample_index", "repeat_index", "pass_index", "completions_id")
META_KEYS = (*ID_KEYS, "answer", "ref_answer", "subject", "fail_reason", "source", "dataset")
ROW_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in ("context", "text", *ID_KEYS, "meta", "ref_answer", "error")])


def read_row(raw: str | None) -> dict:
    """Scalars of an input row, its meta as canonical JSON, its reference answer if a string; ``error`` if not JSON."""
    out: dict = dict.fromkeys(ROW_TYPE.names)
    try:
        value = loads(raw or "")
    except Malformed as e:
        return out | {"error": str(e)}
    row = value if isinstance(value, dict) else {}
    out |= {k: scalar(row.get(k)) for k in ("context", "text", *ID_KEYS)}
    reference = row.get("ref_answer")
    return out | {"meta": dumps({k: row[k] for k in META_KEYS if k in row}), "ref_answer": reference if type(reference) is str else None}


@F.pandas_udf(ROW_TYPE)
def parse_row(raws: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_row(r) for r in raws], columns=ROW_TYPE.names)


@F.pandas_udf(T.StructType([T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())]))
def item_answer(texts: pd.Series) -> pd.DataFrame:
    """The answer of a generated item's JSON, trimmed; an error if it is no such item or its answer is blank."""

    def read(text: str | None) -> tuple[str | None, str | None]:
        try:
            value = loads(text or "")
            if not isinstance(value, dict) or not set(value) <= ITEM_FIELDS:
                raise Malformed("it has other fields")
            answer = _item(value)["answer"].strip(_SPACE)
        except Malformed as e:
            return None, f"generated_item_json is not a generated item: {e}"
        return (answer, None) if answer else (None, "generated_item_json answer is empty")

    return pd.DataFrame([read(t) for t in texts], columns=["answer", "error"])


#: Fields of finished rows that exports read (fixed names), and what stands for the item's answer.
RECORD_FIELDS = ("task_id", "sample_id", "status", "answer_model", "user", "rewritten_user", "assistant", "ref_answer")
RECORD_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in (*RECORD_FIELDS, "expected_answer", "error")])


def read_record(raw: str | None) -> dict:
    """Text fields of a finished row; the item's answer is '' where there is none, malformed items included."""
    try:
        value = loads(raw or "")
        if not isinstance(value, dict):
            raise Malformed("a row is an object")
    except Malformed as e:
        return dict.fromkeys(RECORD_TYPE.names) | {"error": str(e)}
    text = lambda holder, n: holder[n] if type(holder.get(n)) is str else ""
    try:
        item = loads(text(value, "generated_item_json"))
    except Malformed:
        item = {}
    answer = text(item, "answer") if isinstance(item, dict) else ""
    return {n: text(value, n) for n in RECORD_FIELDS} | {"expected_answer": answer, "error": None}


@F.pandas_udf(RECORD_TYPE)
def parse_record(raws: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_record(r) for r in raws], columns=RECORD_TYPE.names)
