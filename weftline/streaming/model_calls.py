"""Calls to chat models as a request/response table boundary.

Requests are rows with a key; a transport turns them into responses. ``replay`` joins a table of earlier responses,
``http`` posts from executors with bounded concurrency. Results must be materialised before they are used twice: a
call that is paid for should not be repeated by a second evaluation of the plan.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import replace
from http.client import HTTPException

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.plain import call_partitions
from weftline.functions.strictjson import Malformed, loads
from weftline.plans.config import Model

ATTEMPTS, PAUSE_S = 3, 2  # fixed values: tries for a call, and seconds times the try between them
RESPONSE = "request_key string, content string, reasoning string, error string"


def request_key(role: Column, model: Column, prompt: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", role, model, prompt), 256)


def request_body(model: Model, prompt: str, json_mode: bool) -> dict:
    """What is posted. Streaming is not asked for in JSON mode."""
    messages = ([{"role": "system", "content": model.system_prompt}] if model.system_prompt else []) + [{"role": "user", "content": prompt}]
    body: dict = {"model": model.model_name, "messages": messages}
    for name in ("max_completion_tokens", "reasoning_effort", "enable_thinking"):
        if getattr(model, name) is not None:
            body[name] = getattr(model, name)
    if model.thinking:
        body["thinking"] = {"type": model.thinking}
    if model.stream and not json_mode:
        body["stream"] = True
    if json_mode:
        body["response_format"] = {"type": "json_object"}
    return body


def _text(holder, key: str) -> str:
    value = holder.get(key) if isinstance(holder, dict) else None
    return value if type(value) is str else ""


def _result(content: str, reasoning: str, what: str) -> tuple[str, str | None]:
    content, reasoning = content.strip(), reasoning.strip()
    if not content and not reasoning:
        raise Malformed(f"{what} is empty")
    return content, reasoning or None


def parse_body(body: str) -> tuple[str, str | None]:
    """(content, reasoning) of a whole response."""
    value = loads(body)
    choices = value.get("choices") if isinstance(value, dict) else None
    if not isinstance(choices, list) or not choices:
        raise Malformed("chat response is missing choices[0]")
    if not isinstance(choices[0], dict) or "message" not in choices[0]:
        raise Malformed("chat response is missing choices[0].message")
    message = choices[0]["message"]
    reasoning = next((t for t in (_text(message, k).strip() for k in ("reasoning_content", "reasoning")) if t), "")
    return _result(_text(message, "content"), reasoning, "chat response")


def parse_events(body: str) -> tuple[str, str | None]:
    """(content, reasoning) of an event stream that has been read to its end."""
    content, reasoning, seen = [], [], False
    for line in body.splitlines():
        kind, _, data = line.strip().partition("data:")
        data = data.strip()
        if kind or not data:
            continue
        if data == "[DONE]":
            break
        value = loads(data)
        seen = True
        choices = value.get("choices") if isinstance(value, dict) else None
        for choice in choices if isinstance(choices, list) else []:
            holder = choice
            if isinstance(choice, dict):
                holder = choice["delta"] if "delta" in choice else choice.get("message", choice)
            reasoning += [_text(holder, "reasoning_content"), _text(holder, "reasoning")]
            content.append(_text(holder, "content"))
    if not seen:
        raise Malformed("stream response did not contain any data chunks")
    return _result("".join(content), "".join(reasoning), "chat stream response")


def parse_response(body: str, content_type: str | None, streamed: bool) -> tuple[str, str | None]:
    """By what was asked for, or by the response's content type."""
    events = streamed or "text/event-stream" in (content_type or "").lower()
    return parse_events(body) if events else parse_body(body)


def replay(requests: DataFrame, responses: DataFrame, order: str | None = None) -> DataFrame:
    """Requests with the first response of their key; a request without one gets an error. First is the least by ``order``,
    else by content and reasoning, so that every run replays the same."""
    said = F.struct("content", "reasoning")
    first = responses.groupBy("request_key").agg(F.min_by(said, F.col(order) if order else said).alias("said"), F.lit(True).alias("__met"))
    joined = requests.join(first.select("request_key", "said.*", "__met"), "request_key", "left")
    return joined.withColumn("error", F.when(F.col("__met").isNull(), "no response is recorded")).drop("__met")


def with_retry(post: Callable[[], tuple[int, str | None, str]], streamed: bool, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, str | None]:
    """(content, reasoning, error). Connection faults, 429 and server errors are tried again; malformed bodies are not."""
    error = ""
    for attempt in range(1, ATTEMPTS + 1):
        try:
            status, kind, body = post()
            if 200 <= status < 300:
                return (*parse_response(body, kind, streamed), None)
            error = f"chat completion failed with status {status}: {body.strip()[:400]}"
            if status != 429 and status < 500:
                break
        except (OSError, HTTPException) as e:  # no connection, no answer in time, or one that was cut off
            error = str(e) or type(e).__name__
        except Malformed as e:
            return None, None, str(e)
        if attempt < ATTEMPTS:
            sleep(PAUSE_S * attempt)
    return None, None, error


def http(requests: DataFrame, model: Model, concurrency: int, total: int, json_mode: bool, timeout_s: float = 240, key_variable: str | None = None, env_proxy: bool = False) -> DataFrame:
    """Post each request (request_key, prompt) from ``concurrency`` tasks, over HTTP/1.1 (the only one this client speaks).

    The key is read from the executors' environment if a variable's name is given; else it goes out as a broadcast. Neither
    the plan nor the function in it holds the key. Proxies of the environment are used only if asked for.
    """
    shared = None if key_variable else requests.sparkSession.sparkContext.broadcast(model.api_key)
    model = replace(model, api_key="")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        key = os.environ[key_variable] if key_variable else shared.value
        opener = urllib.request.build_opener(*([] if env_proxy else [urllib.request.ProxyHandler({})]))
        for batch in batches:
            out = []
            for request, prompt in zip(batch["request_key"], batch["prompt"], strict=True):
                body = json.dumps(request_body(model, prompt, json_mode)).encode()

                def post(body: bytes = body) -> tuple[int, str | None, str]:
                    r = urllib.request.Request(model.endpoint, body, {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
                    try:
                        with opener.open(r, timeout=timeout_s) as got:
                            return got.status, got.headers.get("Content-Type"), got.read().decode(errors="replace")
                    except urllib.error.HTTPError as e:
                        return e.code, None, e.read().decode(errors="replace")

                out.append((request, *with_retry(post, model.stream and not json_mode)))
            yield pd.DataFrame(out, columns=["request_key", "content", "reasoning", "error"])

    asked = requests.select("request_key", "prompt").repartition(call_partitions(concurrency, total), "request_key")
    return requests.join(asked.mapInPandas(run, RESPONSE), "request_key")


def recorded_bodies(bodies: DataFrame, body: str = "body", streamed: str = "streamed") -> DataFrame:
    """Add content, reasoning and error to raw response bodies."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text, events in zip(batch[body], batch[streamed], strict=True):
                try:
                    found.append((*parse_response(text or "", None, bool(events)), None))
                except Malformed as e:
                    found.append((None, None, str(e)))
            yield batch.assign(**{n: [f[i] for f in found] for i, n in enumerate(("content", "reasoning", "error"))})

    kinds = ", ".join(f"{n} {t}" for n, t in bodies.dtypes)
    return bodies.mapInPandas(run, f"{kinds}, content string, reasoning string, error string")
