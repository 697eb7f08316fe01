"""Prompts: how they are drawn, filled and read. The wording is our own; the contracts are those of the catalogue.

A prompt draws its variant once from a seeded generator, is filled with the information, and reads the model's answer into a
flat list of messages (question, answer, ...), or raises ``ParseError``.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable
from dataclasses import dataclass

FORM = "Write pairs of lines that begin with 'Question:' and 'Answer:', with an empty line between pairs."


class ParseError(ValueError):
    """The model's answer doesn't hold to the form."""


def read_pairs(text: str, turns: int = -1, word: str = "Question", lenient: bool = False) -> list[str]:
    """Messages of a transcript; see :func:`..functions.text.parse_transcript`, which does the same on columns."""
    text = re.sub(r"Turn \d{1,2}\n", "", text)
    gap = r"\n+" if lenient else r"\n\n"
    found = re.findall(rf"(?s){word}:\s*(.*?)\s*\n\s*Answer:\s*(.*?)(?={gap}{word}:|\Z)", text)
    if not found or turns >= 0 and len(found) != turns:
        raise ParseError(f"{len(found)} pairs, {turns if turns >= 0 else 'some'} expected")
    out = []
    for q, a in found:
        q, a = q.strip(), a.strip()
        if not q or not a:
            raise ParseError("an empty side")
        out += [q, a[:-1] if len(a.split()) < 3 and a.endswith(".") else a]
    return out


@dataclass(frozen=True)
class Draw:
    """A drawn variant: the task's text, and what reading the answer needs."""

    task: str
    turns: int = -1
    extra: tuple = ()


@dataclass(frozen=True)
class Prompt:
    name: str
    draw: Callable[[random.Random], Draw]
    read: Callable[[str, Draw], list[str]]

    def fill(self, information: list[str], draw: Draw) -> str:
        return f"{draw.task}\n\n[information]\n" + "\n".join(information)


REGISTRY: dict[str, Prompt] = {}


def prompt(name: str, draw: Callable[[random.Random], Draw], read: Callable[[str, Draw], list[str]] | None = None) -> None:
    REGISTRY[name] = Prompt(name, draw, read or (lambda text, d: read_pairs(text, d.turns)))


def fixed(name: str, task: str, turns: int = -1, read: Callable[[str, Draw], list[str]] | None = None) -> None:
    prompt(name, lambda rng: Draw(f"{task} {FORM}", turns), read)


def _or_failed(text: str, d: Draw) -> list[str]:
    return [] if "[failed]" in text else read_pairs(text, d.turns)


fixed("llava_conversation", "Make a conversation of a person who asks about a picture and an assistant who sees it. Ask only what the information answers for certain.")
fixed("llava_detail", "Ask once for a description in detail of the picture, and give it in full sentences.", 1)
fixed("llava_complex_reasoning", "Ask one question that needs a conclusion from what is in the picture, and answer it with the reasons.", 1)
fixed("llavar", "Make a conversation about the words that can be read in the picture and what they say about it.")
fixed("docowl", "Make a conversation about the document in the picture: what it says, where, and how its parts belong together.")
fixed("polite_flamingo", "Make a conversation in which the assistant answers kindly, in full sentences, with what the information gives.")
fixed("lvis_conversation", "Make a conversation about the objects of the picture, those that are missing too.")
fixed("lvis_detail", "Ask once for a description of the objects and their places, and give it. Write [failed] if the information isn't enough.", 1, _or_failed)
fixed("lvis_instruct", "")
fixed("caption", "Ask once for a caption of the picture, and give one of one or two sentences.", 1)
fixed("detail", "Ask once for everything that can be seen, and tell it in order from near to far.", 1)
fixed("template", "Answer with pairs about the information.")

#: Building stones of tasks that the prompt ``instruction`` draws from: what to write, about what, for whom.
_FORMS = ("a short story", "a news item", "a poem", "a letter", "a dialogue", "a riddle", "a list of advice", "a title with three headings", "a diary entry", "a lesson")
_MATTERS = ("what happens", "the mood", "the place", "the people", "the most unusual thing", "what may come next")
_READERS = ("a child", "a visitor", "an expert")
TASKS = tuple(f"Write {f} about {m} in the picture, for {r}." for f in _FORMS for m in _MATTERS for r in _READERS)


def _instruction(rng: random.Random) -> Draw:
    return Draw("Choose the task of these that suits the picture best, put it as the question, and do it as the answer:\n" + "\n".join(f"- {t}" for t in rng.sample(TASKS, 3)) + f"\n{FORM}", 1)


prompt("instruction", _instruction)


def _vqa_detail(rng: random.Random) -> Draw:
    n, style = rng.randint(2, 5), rng.choice(("one word or phrase", "one sentence", "several sentences"))
    return Draw(f"Ask {n} questions about details of the picture and answer each in {style}. {FORM}", n)


prompt("vqa_detail", _vqa_detail)

BLANK = "<fill-in-the-blank>"


def _blank(rng: random.Random) -> Draw:
    n = rng.randint(2, 5)
    return Draw(f"Write {n} statements about the picture in which {BLANK} stands for one word, each as 'Statement:' with the word as 'Answer:', with an empty line between them.", n, (rng.choice(("Fill in the blank:", "Complete the sentence:")),))


def _read_blank(text: str, d: Draw) -> list[str]:
    messages = read_pairs(text, d.turns, "Statement")
    kept = [(q, a) for q, a in zip(messages[::2], messages[1::2]) if BLANK in q]
    if not kept:
        raise ParseError("no blank")
    return [x for i, (q, a) in enumerate(kept) for x in (f"{d.extra[0]} {q}" if i == 0 else q, a)]


prompt("vqa_fill_in_the_blank", _blank, _read_blank)


def _closed(words: tuple[str, str], asks: str, head: str) -> tuple[Callable[[random.Random], Draw], Callable[[str, Draw], list[str]]]:
    """Pairs that begin with ``head`` and are answered by one of two words; the first stays first and says so, the others are mixed."""

    def draw(rng: random.Random) -> Draw:
        n, first = rng.randint(2, 5), rng.randint(0, 1)
        order = ", ".join(words[(first + k) % 2] for k in range(n))
        form = FORM.replace("Question:", f"{head}:")
        return Draw(f"Think first, then write [done], then {asks.format(n=n)}, in this order: {order}. {form}", n, (rng.getrandbits(32),))

    def read(text: str, d: Draw) -> list[str]:
        messages = read_pairs(text.rsplit("[done]", 1)[-1], d.turns, head)
        (question, answer), *rest = zip(messages[::2], messages[1::2])
        if not any(a.lower() in words for a in messages[1::2]):
            raise ParseError("no answer of the two")
        if not all(w in question.lower() for w in words):
            question += f" Answer with {words[0].capitalize()} or {words[1].capitalize()}."
        random.Random(d.extra[0]).shuffle(rest)
        return [x for pair in [(question, answer), *rest] for x in pair]

    return draw, read


prompt("vqa_yes_no", *_closed(("yes", "no"), "ask {n} questions about the picture that are answered by yes or no", "Question"))
prompt("vqa_true_false", *_closed(("true", "false"), "make {n} statements about the picture that are true or false", "Statement"))

#: Building stones of questions that a picture can't answer: what they are about, how they are spread, and a model for them.
_STRATEGIES = ("what a picture can't show", "names and ages that aren't given", "what lies outside the frame", "what happened before", "what people think")
_SPREADS = ("Begin with a question that can be answered and come to the others step by step.", "Ask one that can be answered, then only others.", "Ask one that can't be answered, then only those that can.", "Begin with those that can't be answered and end with those that can.", "Mix both kinds.", "Ask as many of one kind as of the other.")
_MODELS = ("At a harbour without a ship one may ask what colour the ship's flag has.", "In a kitchen where soup is stirred one may ask what the radio plays.", "Of a child with a letter one may ask which line it likes best.")


def _avoidance(rng: random.Random) -> Draw:
    n = rng.randint(2, 5)
    return Draw(f"Think first, then write [done], then ask {n} questions about {rng.choice(_STRATEGIES)}, and answer by saying what can be told instead. {rng.choice(_SPREADS)} {rng.choice(_MODELS)} {FORM}", n)


def _read_avoidance(text: str, d: Draw) -> list[str]:
    messages = read_pairs(text.rsplit("[done]", 1)[-1], d.turns)
    kept = [x for q, a in zip(messages[::2], messages[1::2]) if not q.startswith("I see") and q.endswith("?") and "color" not in q for x in (q, a)]
    if not kept:
        raise ParseError("no question is left")
    return kept


prompt("avoidance", _avoidance, _read_avoidance)

# Marks of options as (what they are called, the five marks); those that stand twice or more are as often drawn.
OPTION_MARKS = (
    ("letter", "A B C D E"), ("letter", "A B C D E"), ("letter", "A B C D E"), ("letter", "a b c d e"), ("letter", "a b c d e"), ("word", "One Two Three Four Five"), ("number", "1 2 3 4 5"), ("number", "1 2 3 4 5"),
    ("alphanumeric", "A1 B2 C3 D4 E5"), ("roman numeral", "I II III IV V"), ("roman numeral", "I II III IV V"), ("symbol", "✓ ✗ Δ ○ □"), ("phonetic", "Alpha Bravo Charlie Delta Echo"),
)
# What stands between a mark and its option.
OPTION_ENDS = (".", ")", "", "-", ":", ";")
#: Ways to ask for the form of an answer, from parts: how, and for what; the kind of mark stands for ``{}``.
_ASKED = ("Answer with", "Reply with", "Respond with", "Please answer with", "Please give only", "Name", "Write down", "Choose")
_WITH = ("the {} of the right option.", "the right {}.", "the {} that stands before the right answer.", "the {} of your choice.")
PHRASINGS = tuple(f"{a} {w}" for a in _ASKED for w in _WITH)


def _choice(rng: random.Random) -> Draw:
    n, (kind, marks) = rng.randint(2, 5), rng.choice(OPTION_MARKS)
    return Draw("Ask one question about the picture with five options in lines that begin with 'A.' to 'E.'; A is right, the others are wrong but likely. Begin the question with 'Question:'.", n, (rng.getrandbits(32), rng.choice(PHRASINGS).format(kind), tuple(marks.split()), rng.choice(OPTION_ENDS)))


def _read_choice(text: str, d: Draw) -> list[str]:
    """Question and asked form, then the options under their marks; the answer is the mark of the right one. All five must be there."""
    seed, asked, marks, end = d.extra
    head, *options = re.split(r"\n[A-E]\.\s*", text.partition("Question:")[2])
    if not head.strip() or len(options) != 5:
        raise ParseError("no question with five options")
    order = list(range(d.turns))
    random.Random(seed).shuffle(order)
    lines = [f"{mark}{end} {options[i].strip()}" for mark, i in zip(marks, order)]
    return ["\n".join([f"{head.strip()} {asked}", *lines]), marks[order.index(0)]]


prompt("multiple_choice", _choice, _read_choice)


def _shikra(rng: random.Random) -> Draw:
    where = rng.random() < 0.5
    about = rng.choice(("and give the places of the things you name as [left, bottom, right, top]", "and ask about things at places given as [left, bottom, right, top]")) if where else rng.choice(("in short", "in detail", "about relations", "about numbers of things"))
    return Draw(f"Make a conversation about the picture, {about}. {FORM}", -1, (where,))


def flip_corners(text: str) -> str:
    """In brackets that end with four numbers, y of both corners from the other side; other brackets stay."""
    def flip(m: re.Match) -> str:
        parts = [p.strip() for p in m[1].split(",")]
        try:
            x1, y1, x2, y2 = map(float, parts[-4:])
        except ValueError:
            return m[0]
        return "[" + ", ".join([*parts[:-4], parts[-4], f"{1 - y1:.2f}", parts[-2], f"{1 - y2:.2f}"]) + "]"

    return re.sub(r"\[([^\[\]]*)\]", flip, text)


prompt("shikra", _shikra, lambda text, d: [flip_corners(m) for m in read_pairs(text)])


# Helpers of the loop


def check_prompt(question: str, answer: str, information: list[str]) -> str:
    return f"[check]\nAnswer true if the information bears the answer out, else false.\n[information]\n{' '.join(information)}\nQuestion: {question}\nAnswer: {answer}"


def read_check(text: str) -> bool:
    words = text.strip().lower().split()
    word = words[0].strip(".,!\"'") if words else ""
    if word not in ("true", "false"):
        raise ParseError("neither true nor false")
    return word == "true"


def reduce_prompt(sentences: list[str], questions: list[str]) -> str:
    return "[reduce]\n" + "\n".join(f"{i}: {s}" for i, s in enumerate(sentences)) + "\n[conversation]\n" + "\n".join(questions)


def read_selection(text: str) -> list[int]:
    inside = re.search(r"\[([^\]]*)\]", text)
    if not inside:
        raise ParseError("no list")
    chosen = [int(n) for n in re.findall(r"\d+", inside[1])]
    if not chosen:
        raise ParseError("nothing is selected")
    return chosen


def statement_prompt(qa: list[str]) -> str:
    return "[statements]\nWrite each question with its answer as one statement, a line each.\n" + "\n".join(qa)


def tree_prompt(tree: str) -> str:
    return "[captions]\nTell in sentences, a line each, what the list of objects says.\n" + tree


def converted_lines(text: str, more_than: int = 0) -> list[str]:
    """Lines of a converter's answer with more than that many characters without margins."""
    return [t.strip() for t in text.split("\n") if len(t.strip()) > more_than]


# Weights of the prompts in the published distributions.
DISTRIBUTIONS: dict[str, list[dict]] = {
    "LLaVA": [{"name": "llava_complex_reasoning", "weight": 0.4873}, {"name": "llava_conversation", "weight": 0.3671}, {"name": "llava_detail", "weight": 0.1456}],
    "DocOwl": [{"name": "docowl", "weight": 1.0}],
    "PoliteFlamingo": [{"name": "polite_flamingo", "weight": 1.0}],
    "LLaVAR": [{"name": "llavar", "weight": 1.0}],
    "SHIKRA": [{"name": "shikra", "weight": 1.0}],
    "LVIS": [{"name": "lvis_conversation", "weight": 0.77}, {"name": "lvis_detail", "weight": 0.33}],
}


def listing() -> str:
    """Names of the prompts, a line each."""
    return "\n".join(sorted(REGISTRY))
