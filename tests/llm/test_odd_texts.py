"""Texts that make patterns backtrack, and that have nothing in them, take no long time anywhere."""

import time

import pytest

from lumenweave.llm import leakage, neardup, pairs, quality, truncation

N = 200_000
TEXTS = {"closers": ")" * N + "a", "dots": "." * N + "a", "quotes": '"' * N, "tags": "<" * N, "blanks": " " * N + ".", "marks": "Question: " * (N // 10), "bullets": "- " * (N // 2), "entities": "&a" * (N // 2), "lines": "\n" * N + "x.", "letters": "x" * N, "zero": "​" * N, "control": "\x00\x01" * (N // 2)}


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_time(name):
    text, began = TEXTS[name], time.process_time()
    truncation.Collector().add(1, 0, None, text)
    pairs.rules_of(text, text)
    quality.statistics(text)
    leakage.words_of(text)
    neardup.WORD.findall(text)
    assert time.process_time() - began < 3


@pytest.mark.parametrize("text, start, complete", [("It is...", 5, False), ("It is…", 5, False), ("It is�", 5, False), ("It is.", None, True), ('He said "no"', None, True), ("Good 🙂", None, True), ("It is", None, False), ("It is..", None, True), ("one,", None, False), ("(so", None, False)])
def test_ends(text, start, complete):
    assert truncation.mark_start(text) == start and (truncation.is_complete(text[-1]) and start is None) == complete
