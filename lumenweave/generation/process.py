"""The generation loop of one picture, and its run over a table of pictures.

Everything random comes from a generator seeded by (seed, run, picture, attempt), so a task that runs again gives the same
rows. Results are rows, appended by the caller after the job has succeeded.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.results import SCHEMA
from .model import ClientFactory, ModelClient
from .prompts import REGISTRY, ParseError, check_prompt, read_check, read_selection, reduce_prompt

SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class Settings:
    """Limits of the loop; ``filtering`` verifies pairs and takes used information away."""

    max_count: int = 15
    least_information: int = 100
    reduction_stop: float = 0.85
    most_rejects: int = 3
    tries: int = 3
    filtering: bool = True
    questions_only: bool = True
    attempt: int = 0
    seed: str = "0"


class PromptFailure(Exception):
    """A prompt that couldn't be run; ``kind`` is import, sampling, parsing, output_parsing or engine."""

    def __init__(self, kind: str, message: str) -> None:
        super().__init__(message)
        self.kind = kind


def generator(*parts: object) -> random.Random:
    return random.Random(int.from_bytes(hashlib.sha256("|".join(map(str, parts)).encode()).digest()[:8], "big"))


def ask(model: ModelClient, text: str, read, tries: int):
    """The model's answer, read; tried again if it can't be, with the failure of the last try in the end."""
    failure = PromptFailure("engine", "never asked")
    for _ in range(max(1, tries)):
        try:
            answer = model.generate([{"role": "user", "content": text}])
        except Exception as e:  # the engine's own errors
            failure = PromptFailure("engine", str(e))
            continue
        try:
            return read(answer)
        except ParseError as e:
            failure = PromptFailure("output_parsing", str(e))
    raise failure


def run_prompt(name: str, information: list[str], model: ModelClient, rng: random.Random, tries: int = 3) -> list[str]:
    """Messages of one prompt: drawn once, filled, asked."""
    if name not in REGISTRY:
        raise PromptFailure("import", f"no prompt {name}")
    prompt = REGISTRY[name]
    try:
        draw = prompt.draw(rng)
    except Exception as e:
        raise PromptFailure("sampling", str(e)) from e
    return ask(model, prompt.fill(information, draw), lambda text: prompt.read(text, draw), tries)


def pick(distribution: list[dict], rng: random.Random) -> dict:
    """A prompt by weight: the first whose cumulative weight reaches a uniform number below the sum."""
    at = rng.random() * sum(d["weight"] for d in distribution)
    total = 0.0
    for d in distribution:
        total += d["weight"]
        if total >= at:
            return d
    return distribution[-1]


def verified(pairs: list[tuple[str, str]], information: list[str], model: ModelClient, tries: int) -> list[tuple[str, str]]:
    """Pairs that the information bears out; none if the first isn't. A check that fails counts as no."""
    def holds(q: str, a: str) -> bool:
        try:
            return ask(model, check_prompt(q, a, information), read_check, tries)
        except PromptFailure:
            return False

    if not pairs or not holds(*pairs[0]):
        return []
    return [pairs[0], *[p for p in pairs[1:] if holds(*p)]]


def reduced(information: list[str], messages: list[str], model: ModelClient, tries: int, questions_only: bool = True) -> tuple[list[str], list[str]]:
    """(kept, removed) information: sentences that the conversation used are taken away. If the model names none, all are."""
    parts = [(i, s.strip()) for i, text in enumerate(information) for s in SENTENCE_END.split(text) if s.strip()]
    said = messages[::2] if questions_only else messages
    try:
        chosen = set(ask(model, reduce_prompt([s for _, s in parts], said), read_selection, tries))
    except PromptFailure:
        return [], list(information)

    def joined(inside: bool) -> list[str]:
        items: dict[int, list[str]] = {}
        for k, (i, s) in enumerate(parts):
            if (k in chosen) == inside:
                items.setdefault(i, []).append(s)
        return [" ".join(v) for _, v in sorted(items.items())]

    return joined(False), joined(True)


def process(information: list[str], model: ModelClient, distribution: list[dict], settings: Settings, *key: object) -> list[dict]:
    """Steps of one picture; see the settings for what ends it. A prompt that fails ends it with a row of its error."""
    rng = generator(settings.seed, *key, settings.attempt)
    original, current, steps, rejects = list(information), list(information), [], 0
    left = [dict(d) for d in distribution]
    length = lambda items: sum(map(len, items))
    for step in range(settings.max_count):
        if not left or length(current) < settings.least_information:
            break
        chosen = pick(left, rng)
        row = {"step": step, "prompt_type": chosen["name"], "input": current, "output": None, "filtered_out": None, "error": None}
        try:
            messages = run_prompt(chosen["name"], current, model, rng, settings.tries)
        except PromptFailure as e:
            steps.append(row | {"error": {"type": e.kind, "message": str(e)}})
            break
        if settings.filtering:
            pairs = verified(list(zip(messages[::2], messages[1::2])), original, model, settings.tries)
            if not pairs:
                rejects += 1
                if rejects > settings.most_rejects:
                    break
                continue
            rejects = 0
            messages = [m for p in pairs for m in p]
            kept, removed = reduced(current, messages, model, settings.tries, settings.questions_only)
            steps.append(row | {"output": messages, "filtered_out": removed})
            current = kept
            if length(original) and 1 - length(current) / length(original) > settings.reduction_stop:
                break
        else:
            steps.append(row | {"output": messages})
        if chosen.get("max_samples") is not None:
            chosen["max_samples"] -= 1
            left = [d for d in left if d is not chosen or d["max_samples"] >= 1]
    return steps


def run(information: DataFrame, client: ClientFactory, distribution: list[dict], run_id: str, settings: Settings | None = None) -> DataFrame:
    """Results of ``information(image_path, information)``, lazily; the client is made once in each task."""
    settings = settings or Settings()

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = client()
        for batch in batches:
            rows = []
            for path, items in zip(batch["image_path"], batch["information"]):
                known = [t for t in (items if items is not None else []) if t]
                for s in process(known, model, distribution, settings, run_id, path):
                    rows.append({"image_path": path, "attempt": settings.attempt, **s, "run_id": run_id})
            yield pd.DataFrame(rows, columns=["image_path", "attempt", "step", "prompt_type", "input", "output", "filtered_out", "error", "run_id"])

    return information.where("image_path is not null").select("image_path", "information").mapInPandas(each, SCHEMA)


def retry(information: DataFrame, results: DataFrame, client: ClientFactory, distribution: list[dict], run_id: str, settings: Settings | None = None) -> DataFrame:
    """Another attempt for pictures of the run without any output."""
    settings = settings or Settings()
    done = results.where((F.col("run_id") == run_id) & (F.size("output") > 0)).select("image_path").distinct()
    return run(information.join(done, "image_path", "left_anti"), client, distribution, run_id, replace(settings, attempt=settings.attempt + 1))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts, the same in any engine that has md5."""
    key = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def assign_prompts(rows: DataFrame, distribution: list[dict], *key: str) -> DataFrame:
    """``rows`` with ``prompt_type``, drawn by weight from a hash of the key columns: one expression, no join."""
    total, low = sum(d["weight"] for d in distribution), 0.0
    at, choice = uniform(*[F.col(k) for k in key]) * F.lit(total), None
    for d in distribution:
        low += d["weight"]
        choice = F.when(at <= low, d["name"]) if choice is None else choice.when(at <= low, d["name"])
    return rows.withColumn("prompt_type", choice.otherwise(distribution[-1]["name"]))
