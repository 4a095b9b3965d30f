"""The HTTP transport against a server on this machine: what is sent, what is tried again, and what a broken answer becomes."""

from __future__ import annotations

import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from weftline.plans.config import Model
from weftline.streaming import model_calls


class Server(BaseHTTPRequestHandler):
    """Answers by the prompt's first word."""

    protocol_version = "HTTP/1.1"
    seen: Counter = Counter()
    asked: dict = {}
    lock = threading.Lock()

    def log_message(self, *_):
        pass

    def reply(self, status, body, kind="application/json", size=None):
        self.send_response(status)
        self.send_header("Content-Type", kind)
        self.send_header("Content-Length", str(len(body) if size is None else size))
        self.end_headers()
        self.wfile.write(body)

    def do_POST(self):  # noqa: N802
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        prompt = body["messages"][-1]["content"]
        with self.lock:
            self.seen[prompt] += 1
            tries = self.seen[prompt]
            self.asked[prompt] = (self.request_version, self.headers["Authorization"], body)
        said = json.dumps({"choices": [{"message": {"content": f" said {prompt} é ", "reasoning_content": "why"}}]}, ensure_ascii=False).encode()
        kind = prompt.split()[0]
        if kind == "busy" and tries < 3:
            self.reply(429, b"later")
        elif kind == "broken" or (kind == "once" and tries == 1):
            self.reply(503, "out of ordér".encode("latin-1"))
        elif kind == "refused":
            self.reply(400, b"no such model")
        elif kind == "cut" and tries == 1:
            self.reply(200, said[:20], size=len(said))
            self.close_connection = True
        elif kind == "dropped" and tries == 1:
            self.close_connection = True
            self.connection.close()
        elif kind == "slow" and tries == 1:
            time.sleep(3)
            self.reply(200, said)
        elif kind == "garbage":
            self.reply(200, b"<html>")
        elif kind == "events":
            self.send_response(200)
            self.send_header("Content-Type", "text/event-stream")
            self.send_header("Transfer-Encoding", "chunked")
            self.end_headers()
            lines = [{"choices": [{"delta": {"reasoning": "because "}}]}, {"choices": [{"delta": {"content": "the é"}}]}, {"choices": [{"delta": {"content": "nd"}}]}]
            stream = ": hello\n\n".encode() + b"".join(b"data: " + json.dumps(x, ensure_ascii=False).encode() + b"\n\n" for x in lines) + b"data: [DONE]\n\n"
            for a in range(0, len(stream), 7):  # pieces that part lines and characters
                part = stream[a : a + 7]
                self.wfile.write(f"{len(part):x}\r\n".encode() + part + b"\r\n")
                self.wfile.flush()
            self.wfile.write(b"0\r\n\r\n")
        else:
            self.reply(200, said)


@pytest.fixture(scope="module")
def endpoint():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1/chat"
    server.shutdown()


def model(endpoint, **more):
    return Model(endpoint=endpoint, model_name="m", api_key="the key", **more)


def call(spark, endpoint, prompts, json_mode=False, timeout_s=30.0, **more):
    requests = spark.createDataFrame([(p, p) for p in prompts], "request_key string, prompt string")
    got = model_calls.http(requests, model(endpoint, **more), 8, len(prompts), json_mode, timeout_s).collect()
    assert len(got) == len(prompts)
    return {r.request_key: (r.content, r.reasoning, r.error) for r in got}


def test_statuses_and_faults(spark, endpoint):
    kinds = ["plain 1", "plain 2", "busy 1", "broken 1", "once 1", "refused 1", "cut 1", "dropped 1", "garbage 1", "events 1"]
    got = call(spark, endpoint, kinds)
    for p in ("plain 1", "plain 2", "busy 1", "once 1", "cut 1", "dropped 1"):
        assert got[p] == (f"said {p} é", "why", None), p
    assert got["events 1"] == ("the énd", "because", None)
    assert got["broken 1"][:2] == (None, None) and "status 503" in got["broken 1"][2]
    assert "status 400: no such model" in got["refused 1"][2] and got["garbage 1"][2]
    assert {p: Server.seen[p] for p in kinds} == {"plain 1": 1, "plain 2": 1, "busy 1": 3, "broken 1": 3, "once 1": 2, "refused 1": 1, "cut 1": 2, "dropped 1": 2, "garbage 1": 1, "events 1": 1}


def test_what_is_sent(spark, endpoint):
    got = call(spark, endpoint, ["sent 1"], json_mode=True, stream=True, system_prompt="be kind", max_completion_tokens=7)
    assert got["sent 1"][0] == "said sent 1 é"
    version, key, body = Server.asked["sent 1"]
    assert (version, key) == ("HTTP/1.1", "Bearer the key")
    assert body == {"model": "m", "messages": [{"role": "system", "content": "be kind"}, {"role": "user", "content": "sent 1"}], "max_completion_tokens": 7, "response_format": {"type": "json_object"}}
    call(spark, endpoint, ["events sent"], stream=True)
    assert Server.asked["events sent"][2]["stream"] is True


def test_a_late_answer_is_asked_for_again(spark, endpoint):
    assert call(spark, endpoint, ["slow 1"], timeout_s=1.0)["slow 1"][0] == "said slow 1 é" and Server.seen["slow 1"] == 2


def test_no_server(spark):
    requests = spark.createDataFrame([("k", "p")], "request_key string, prompt string")
    got = model_calls.http(requests, model("http://127.0.0.1:9/"), 1, 1, False, 5).collect()[0]
    assert got.content is None and got.error


def test_the_key_is_in_no_plan(spark, endpoint):
    requests = spark.createDataFrame([("k", "p")], "request_key string, prompt string")
    df = model_calls.http(requests, model(endpoint), 1, 1, False)
    assert "the key" not in df._jdf.queryExecution().toString()
    assert df.select(F.count("*")).first()[0] == 1
