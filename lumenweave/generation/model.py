"""The model behind the generation loop: anything that answers messages with a text."""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from typing import Protocol

Messages = list[dict[str, str]]


class ModelClient(Protocol):
    """Built once in a task, from a factory that is sent to it; must answer the same messages the same way for a retry."""

    def generate(self, messages: Messages, temperature: float = 0.2, max_tokens: int = 1000) -> str: ...


ClientFactory = Callable[[], ModelClient]


class HttpClient:
    """A model behind an HTTP interface for chats in the widely used form: ``POST {url}/chat/completions`` with model and messages.

    A failed call is repeated with growing waits; an answer in another form, or none after the last try, is an error of the step.
    The key is read in the task from the environment variable named, so that it is in no plan.
    """

    def __init__(self, url: str, model: str, key_variable: str | None = None, timeout: float = 120, tries: int = 3, wait: float = 1.0) -> None:
        self.url, self.model, self.key_variable, self.timeout, self.tries, self.wait = f"{url.rstrip('/')}/chat/completions", model, key_variable, timeout, tries, wait

    def generate(self, messages: Messages, temperature: float = 0.2, max_tokens: int = 1000) -> str:
        body = json.dumps({"model": self.model, "messages": messages, "temperature": temperature, "max_tokens": max_tokens}).encode()
        headers = {"Content-Type": "application/json"}
        if self.key_variable:
            headers["Authorization"] = f"Bearer {os.environ[self.key_variable]}"
        for n in range(self.tries):
            try:
                with urllib.request.urlopen(urllib.request.Request(self.url, body, headers), timeout=self.timeout) as answer:
                    return json.load(answer)["choices"][0]["message"]["content"]
            except urllib.error.HTTPError as e:
                if e.code < 500 and e.code != 429 or n + 1 == self.tries:
                    raise
            except (urllib.error.URLError, TimeoutError):
                if n + 1 == self.tries:
                    raise
            time.sleep(self.wait * 2**n)
        raise RuntimeError("no try was made")


class ScriptedClient:
    """Answers by rules: the first (piece of text, answer) whose piece is in the prompt; an answer that is an exception is raised."""

    def __init__(self, rules: list[tuple[str, str | Exception]], default: str = "") -> None:
        self.rules, self.default = rules, default

    def generate(self, messages: Messages, temperature: float = 0.2, max_tokens: int = 1000) -> str:
        prompt = "\n".join(m["content"] for m in messages)
        answer = next((a for piece, a in self.rules if piece in prompt), self.default)
        if isinstance(answer, Exception):
            raise answer
        return answer


class EchoClient:
    """An offline model without knowledge: asks about the information's first sentences, finds every pair right, and
    selects the sentences that a conversation repeats. It makes the loop run end to end where no model is at hand."""

    def __init__(self, pairs: int = 2) -> None:
        self.pairs = pairs

    def generate(self, messages: Messages, temperature: float = 0.2, max_tokens: int = 1000) -> str:
        prompt = messages[-1]["content"]
        if prompt.startswith("[check]"):
            return "true"
        if prompt.startswith("[reduce]"):
            listed, _, said = prompt.partition("\n[conversation]\n")
            rows = [line.split(": ", 1) for line in listed.split("\n")[1:] if ": " in line]
            return "[" + ", ".join(n for n, text in rows if text.rstrip(".!?") in said) + "]"
        body = prompt.split("[information]\n", 1)[-1]
        parts = [s for line in body.split("\n") for s in line.split(". ") if s.strip()]
        task = prompt.split("[information]\n", 1)[0]
        asked = re.search(r"\b(?:[Aa]sk|[Ww]rite|make) (\d)\b", task)
        n = int(asked[1]) if asked else 1 if re.search(r"\bonce\b|\bone question\b|as the question", task) else self.pairs
        start = int(hashlib.md5(body.encode()).hexdigest(), 16) % max(1, len(parts))
        taken = [parts[(start + k) % len(parts)].strip().rstrip(".") for k in range(n if parts else 0)]
        head = "Statement" if "'Statement:'" in task else "Question"
        return "\n\n".join(f"{head}: What about this: {t}?\nAnswer: As described, {t}." for t in taken)
