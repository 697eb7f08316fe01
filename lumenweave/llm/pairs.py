"""Defective question and answer pairs, by ordered rules.

Rules in their order: ``empty``, ``copied``, ``refusal``, ``truncated``, ``language``. All rules that hold come out in
``triggered``; ``defect`` is the first of them, so a pair has one. ``truncated`` is the case of :mod:`.truncation`, which
looks for open ends, unclosed delimiters and pieces of words over the whole corpus; the others look at the pair alone.

A turn's role is read from ``from`` in any case and with blanks. A pair is an answer turn directly after a human turn; an answer
without one, and a last question without an answer, are no pairs. Null questions count as empty texts. Rows without a key are
no records; a repeated key counts once.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import truncation

# Spellings of the two roles.
HUMAN, ANSWER = ("human", "user", "question", "prompter"), ("gpt", "assistant", "answer", "model", "bot")

RULES = ("empty", "copied", "refusal", "truncated", "language")
WORD = re.compile(r"[^\W_]+")
LABEL = re.compile(r"^\W*(?:answer|response|reply|antwort|réponse|respuesta|risposta|resposta|assistant|gpt|a)\s*:", re.I)
ASKED = re.compile(r"^\W*(?:you asked|question|frage|pregunta|domanda|pergunta|human|user|q)\s*:", re.I)
TAG = re.compile(r"<[a-z_/]+>", re.I)
QUOTED = re.compile(r"\"[^\"]*(?:\"|$)|“[^”]*(?:”|$)|„[^“”]*(?:[“”]|$)|«[^»]*(?:»|$)")

# Phrases by which assistants decline, by language; a blank stands for any white space.
_DO = "(?:help|assist|answer|provide|view|process|do (?:that|this|so)|describe|look|comment|discuss|comply|fulfil|fulfill|share|create|generate|identify|respond|continue|engage|analy[sz]e|support|complete|give|offer|translate|write|open|access|display|reply|participate|talk|speak)"
_NOT = "(?:can ?not|can['’]?t|could not|couldn['’]t|will not|won['’]?t|would not|wouldn['’]t|do not|don['’]?t|may not|must not|am not (?:able|allowed|permitted|willing|comfortable) to|['’]m not (?:able|allowed|permitted|willing) to|am unable to|['’]m unable to|be able to|have to decline|must decline|decline to|refuse to|am not going to|['’]m not going to|am not comfortable|['’]m not comfortable)"
def _phrase(pattern: str) -> re.Pattern[str]:
    return re.compile(pattern.replace(" ", r"\s+").replace(r"\s+?", r"\s*"), re.I)


REFUSAL = _phrase(
    "|".join(
        [
            rf"\bi ?{_NOT}\b(?:\s+(?:really|possibly|currently|unfortunately|simply|just|able to|be able to|to))*\s+{_DO}\b",
            r"\bi (?:must|have to) (?:decline|refuse)\b",
            r"\bi (?:am|['’]?m) (?:unable|not able) to (?!see|tell|make out|read)",
            r"\bi (?:do not|don['’]?t) feel (?:comfortable|able)\b",
            r"\b(?:it is|it['’]s) (?:not possible|impossible) for me to\b",
            r"\bnot something i(?: can|['’]m able)\b",
            r"\bi can['’]?t fulfil",
            r"\bagainst my (?:guidelines|policy|policies|rules|programming)\b",
            r"\b(?:my|our) (?:guidelines|policies|policy) (?:do not|don['’]?t|prevents?|prohibits?)\b",
            r"\bes ist mir (?:leider )?nicht (?:möglich|erlaubt|gestattet)\b|\bich muss (?:leider )?ablehnen\b",
            r"\bil m['’]est (?:malheureusement )?(?:impossible|interdit)\b|\bil ne m['’]est pas (?:possible|permis)\b|\bje dois (?:refuser|décliner)\b|\bje refuse\b",
            r"\bno me (?:está|es) (?:permitido|posible|permitida)\b|\bme es imposible\b|\bdebo (?:rechazar|negarme|declinar)\b|\bme niego a\b",
            r"\bnão (?:posso|consigo|estou autorizado|me é (?:possível|permitido))\b",
            r"\bhet is (?:voor )?(?:mij|me) (?:helaas )?niet (?:mogelijk|toegestaan)\b|\bik moet (?:helaas )?weigeren\b|\bik weiger\b",
            r"\bmuszę (?:niestety )?odmówić\b|\bodmawiam\b",
            r"\bdet är (?:tyvärr )?inte (?:möjligt|tillåtet) för mig\b|\bjag måste (?:tyvärr )?(?:avböja|neka|vägra)\b|\bjag vägrar\b",
        ]
    )
)
#: Phrases whose parts follow one another with other words of the sentence between them.
REFUSAL_PARTS = [
    tuple(map(_phrase, parts))
    for parts in (
        (r"\bas an? (?:ai|artificial|language model|assistant)\b", r"\b(?:can ?not|can['’]?t|unable|not able|don['’]?t|do not|not allowed)\b"),
        (r"\bich (?:kann|darf|werde|möchte|will)\b", r"\b(?:nicht|nichts|keine[nrms]?|leider)\b", r"\b(?:helfen|beantworten|beschreiben|weiterhelfen|antworten|geben|tun|erfüllen|anzeigen|kommentieren|ansehen|verarbeiten|unterstützen)\b"),
        (r"\b(?:kann|darf|werde|möchte) ich\b", r"\b(?:nicht|nichts|keine[nrms]?)\b", r"\b(?:helfen|beantworten|beschreiben|weiterhelfen|antworten|geben|tun|erfüllen|anzeigen|kommentieren|ansehen|verarbeiten|unterstützen)\b"),
        (r"\bje ne (?:peux|puis|suis|veux|souhaite)\b", r"\b(?:pas|répondre|aider|décrire)\b"),
        (r"\bno (?:puedo|podré|podría|voy a|quiero|debo)\b", r"\b(?:ayudar\w*|responder\w*|describir\w*|contestar\w*|hacer\w*|dar\w*|proporcionar\w*|comentar\w*|asistir\w*|ver|procesar)\b"),
        (r"\bnon (?:posso|sono in grado|mi è (?:possibile|permesso))\b", r"\b(?:aiutar\w*|rispondere|descrivere|di|fornire|assister\w*)\b"),
        (r"\bik (?:kan|mag|zal|wil)\b", r"\b(?:niet|niets|geen)\b", r"\b(?:helpen|beantwoorden|beschrijven|antwoorden|geven|doen|uitvoeren|weergeven|bekijken|verwerken|ondersteunen|verstrekken)\b"),
        (r"\b(?:kan|mag|zal|wil) ik\b", r"\b(?:niet|niets|geen)\b", r"\b(?:helpen|beantwoorden|beschrijven|antwoorden|geven|doen|uitvoeren|weergeven|bekijken|verwerken|ondersteunen|verstrekken)\b"),
        (r"\bnie (?:mogę|jestem w stanie|będę|chcę|potrafię|wolno mi)\b", r"\b(?:pomóc|pomagać|odpowiedzieć|odpowiadać|opisać|opisywać|podać|udzielić|zrobić|spełnić|wyświetlić|skomentować|przetworzyć|wygenerować|zidentyfikować|udostępnić)\b"),
        (r"\bjag (?:kan|får|vill|kommer)\b", r"\b(?:inte|inget|inga|ingen)\b", r"\b(?:hjälpa|svara|besvara|beskriva|ge|göra|visa|kommentera|bearbeta|tillhandahålla|identifiera|generera)\b"),
        (r"\b(?:kan|får|vill|kommer) jag\b", r"\b(?:inte|inget|inga|ingen)\b", r"\b(?:hjälpa|svara|besvara|beskriva|ge|göra|visa|kommentera|bearbeta|tillhandahålla|identifiera|generera)\b"),
    )
]
# Words of which one is in every phrase above.
_DECLINING = frozenset("i i'm i’m i'd my our ai assistant possible impossible im ich mir je m il no non não me debo ik mij nie odmawiam muszę jag mig".split()) | frozenset(("m'est", "m’est", "n'est"))
SENTENCE_END = re.compile(r"[.!?。！？]+(?=\s|$)|\n")
STOP = re.compile(r"[.!?]+")
# Words of sentences about the talk itself (apologies, thanks, offers, the request, rules), which tell nothing.
ABOUT_TALK = re.compile(
    r"\b(?:sorry|apologi[sz]e|apologies|thanks?|please|unfortunately|understand|assist(?:ance)?|help|feel free|let me know|happy to|glad to|questions?|requests?|asking|guidelines|polic(?:y|ies)|privacy|unable"
    r"|leid|leider|danke?|bitte|verständnis|fragen?|anfrage|entschuldigung|désolée?|merci|malheureusement|questions?|demande|excuse[rz]?|siento|gracias|lamento|pregunta|solicitud|disculpa\w*|ayudar\w*"
    r"|spiace|grazie|domanda|richiesta|scus\w+|desculp\w+|obrigad[oa]|pergunta|pedido|infelizmente|lamentablemente|purtroppo"
    r"|spijt|helaas|bedankt|vraag|vragen|verzoek|przykro|przepraszam|niestety|dziękuję|proszę|pytani\w+|prośb\w+|tyvärr|ledsen|tack|fråg\w+|förfrågan)\b",
    re.I,
)

ASKS_LANGUAGE = re.compile(
    r"\btranslat|\bübersetz|\btradui|\btraduc|\btradurr|\btraduz"
    r"|\b(?:in|into|to|auf|ins|en|em|al|au|in)\s+(?:english|german|french|spanish|italian|portuguese|russian|japanese|chinese|dutch|polish|korean|arabic|greek|turkish|latin|swedish|deutsche?|englische?|französische?|spanische?|italienische?|russische?|japanische?|anglais|allemand|français|espagnol|italien|russe|japonais|inglés|alemán|francés|español|italiano|ruso|japonés|inglese|tedesco|francese|spagnolo)\b"
    r"|\bhow do you say\b|\bwie sagt man\b|\bcomment dit-on\b|\bcómo se dice\b|\bcome si dice\b",
    re.I,
)

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the a an of and is are was were it its to with what which who how where why this that these there from at by for be has have can could does do you not they their he she his her one in on as or into",
    "de": "der die das den dem des ein eine einen einem einer und ist sind war mit auf im am zum zur nicht sich man sieht wie was wo wer welche warum es sie er bei von für aus nach über unter neben vor wird dass weil auch noch bitte steht hängt",
    "fr": "le la les l un une des du de et est sont dans sur sous avec près que qui où quelle quel pourquoi comment il elle on ce cette au aux ne pas plus par pour en à côté se d qu",
    "es": "el la los las un una unos unas del de y es son está en con sobre cerca que qué quién dónde cómo por para se al lo junto hay también más no su cuál puedes",
    "it": "il lo la gli le i un uno una di del della dei nella nel sullo sulla e è sono con per che chi dove come si al alla c più non vicino sopra anche cosa",
    "pt": "o a os as um uma de do da dos das e é são em no na nos nas com por para que quem onde como se ao à mais não perto também",
    "nl": "de het een van en is zijn op in met voor niet dat die wat waar wie hoe er naar ook aan bij staat",
    "pl": "i w na z jest są nie się to że do od po co kto gdzie jak przy obok oraz",
    "cs": "že který která jsou před není také nebo při vedle kde proč několik něco",
    "tr": "bir ve bu için çok olan olarak değil gibi daha üzerinde yanında nerede hangi",
    "da": "og ikke hvad hvor hvorfor eller være noget ved siden står",
    "fi": "että mitä missä ovat myös vieressä kuvassa hän joka vieressään",
    "hu": "és nem egy hogy mellett milyen hol vannak ezen képen",
    "ro": "și este cu pe lângă sunt unde care câți această din pentru",
    "sv": "och i en ett är på med det den som för inte av till vad var hur vem står",
}
_LANGUAGES: dict[str, list[str]] = {}
for _language, _words in FUNCTION_WORDS.items():
    for _word in {w for w in _words.split() if len(w) > 1}:
        _LANGUAGES.setdefault(_word, []).append(_language)


@lru_cache(maxsize=65536)
def script_of(letter: str) -> str:
    """Script of a letter by its Unicode name; kana and ideographs count as one."""
    name = unicodedata.name(letter, "").split(" ")[0]
    return "EAST" if name in ("CJK", "HIRAGANA", "KATAKANA", "FULLWIDTH", "HALFWIDTH") else name


#: A text with two of these is taken for English without further look.
_ENGLISH = frozenset("the is are what which how where of this there and does".split())


def languages_of(text: str, words: list[str]) -> dict[str, float]:
    """Scores of the languages of a text: of a script other than Latin if most letters have it, else by function words."""
    if not text.isascii():
        scripts = Counter(script_of(c) for c in text if c.isalpha())
        if scripts:
            script, n = scripts.most_common(1)[0]
            if script != "LATIN" and n * 2 > scripts.total():
                return {script: float(n)}
    score: dict[str, float] = {}
    for w in words:
        own = _LANGUAGES.get(w)
        if own:
            for language in own:
                score[language] = score.get(language, 0.0) + 1.0 / len(own)
    return score


def other_language(question: dict[str, float], answer: dict[str, float]) -> bool:
    """Whether the answer's language is none of those that the question may be in; unclear texts are in no other language."""
    if not question or not answer:
        return False
    least, most = max(question.values()), max(answer.values())
    if least < 0.9 or most < 1.2:
        return False
    return all(answer.get(language, 0.0) < 0.4 * most for language, n in question.items() if n >= 0.7 * least)


def copied(question: list[str], answer: list[str]) -> bool:
    """Whether the answer has the question's words and their order and little else; repeating it or a slip makes no difference."""
    if len(answer) < 2 or len(question) < 2 or 2 * len(answer) < len(question):
        return False
    q, a = set(question), set(answer)
    if len(q & a) < 0.7 * len(q | a):
        return False
    pairs = set(zip(question, question[1:]))
    return sum(p in pairs for p in zip(answer, answer[1:])) >= 0.6 * (len(answer) - 1)


def refuses(text: str) -> bool:
    """Whether a phrase by which assistants decline is in the text. Parts are looked for one after the other: no backtracking."""
    for piece in STOP.split(text):
        if REFUSAL.search(piece):
            return True
        for parts in REFUSAL_PARTS:
            at = 0
            for part in parts:
                found = part.search(piece, at)
                if not found:
                    break
                at = found.end()
            else:
                return True
    return False


def declines(text: str, question: list[str]) -> bool:
    """Whether an answer declines and tells less than that: as many of its sentences decline, wherever, as tell something.

    Sentences about the talk itself and those that only repeat the question tell nothing.
    """
    text = QUOTED.sub(" ", text) if any(c in text for c in '"“„«') else text
    if not refuses(text):
        return False
    asked, balance = set(question), 0
    for sentence in SENTENCE_END.split(text):
        if refuses(sentence):
            balance += 1
        elif not ABOUT_TALK.search(sentence):
            words = words_of(sentence)
            balance -= bool(words) and sum(w in asked for w in words) < 0.7 * len(words)
    return balance >= 0


def role_of(name: str | None) -> int:
    """1 for a human turn, 2 for an answer, 0 for any other."""
    plain = (name or "").strip().lower()
    return 1 if plain in HUMAN else 2 if plain in ANSWER else 0


def words_of(text: str | None) -> list[str]:
    return [t for t in truncation.TOKEN.findall(TAG.sub(" ", text).lower()) if t not in truncation.BREAK] if text else []


def rules_of(question: str | None, answer: str | None, q: list[str] | None = None, a: list[str] | None = None) -> list[str]:
    """The rules that look at the pair alone, in order; ``empty`` excludes all others. ``q``, ``a``: the texts' words."""
    q, a = words_of(question) if q is None else q, words_of(answer) if a is None else a
    if not a:
        return ["empty"]
    question, bare, found = question or "", answer, []
    if len(a) > 1 or ":" in bare:
        if "<" in bare:
            bare = TAG.sub(" ", bare)
        if ":" in bare:
            labelled = LABEL.match(bare)
            if labelled and not WORD.search(bare, labelled.end()):
                return ["empty"]
            asked = ASKED.match(bare)
            a = words_of(bare[asked.end() :]) if asked else a
        if ":" in question and ASKED.match(question):
            q = words_of(ASKED.sub("", question))
        if copied(q, a):
            found.append("copied")
    if not _DECLINING.isdisjoint(a):
        if declines(bare, q):
            found.append("refusal")
    if (len(a) > 1 or not bare.isascii()) and not (len(_ENGLISH.intersection(q)) > 1 and len(_ENGLISH.intersection(a)) > 1):
        if other_language(languages_of(question, q), languages_of(bare, a)) and not ASKS_LANGUAGE.search(question):
            found.append("language")
    return found


def examine(chats: DataFrame) -> DataFrame:
    """Rows of :data:`.truncation.EVIDENCE` from one pass over ``chats(export_id, image_source, conversations)``.

    Besides what :mod:`.truncation` gathers there is a row with ``found`` and without ``n_chars`` for every answer of a pair for
    which rules hold that look at the pair alone. Values without an end that are such answers have an empty ``found``.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collector, breaks = truncation.Collector(), truncation.BREAK
        roles: dict[str | None, int] = {None: 0}
        for batch in batches:
            keys, sources, who, said = (batch.column(i) for i in range(4))
            starts = said.offsets.to_pylist()
            names, texts = who.values.to_pylist(), said.values.to_pylist()
            judged = []
            for key, source, start, end in zip(keys.to_pylist(), sources.to_pylist(), starts, starts[1:]):
                before, question, q = 0, None, []
                for turn in range(end - start):
                    name, value = names[start + turn], texts[start + turn]
                    role = roles.get(name)
                    if role is None:
                        role = roles[name] = role_of(name)
                    n = len(collector.tails)
                    words = [t for t in collector.add(key, turn, source, value) if t not in breaks] if value else []
                    if role == 2 and before == 1:
                        if len(collector.tails) > n:  # an open end of a pair's answer is marked by an empty list
                            tail = collector.tails[-1]
                            collector.tails[-1] = (*tail[:3], [], *tail[4:])
                        found = rules_of(question, value, q, words)
                        if found:
                            judged.append((key, turn, source, found))
                    before, question, q = role, value, words
            tails = collector.batch_rows()
            if judged:
                yield truncation.arrow_rows(judged)
            if tails:
                yield truncation.arrow_rows(tails)
            if collector.full():
                yield from collector.counts()
        yield from collector.counts()

    read = chats.where("export_id is not null and conversations is not null").select("export_id", "image_source", F.col("conversations.from").alias("roles"), F.col("conversations.value").alias("texts"))
    return read.mapInArrow(look, truncation.EVIDENCE)


def defects(chats: DataFrame) -> DataFrame:
    """``(export_id, turn_no, defect, triggered)`` of every defective pair."""
    rows = materialise(examine(chats))
    alone = rows.where("found is not null and n_chars is null").select("export_id", "turn_no", "found").dropDuplicates(["export_id", "turn_no"])
    cut = truncation.cut_values(rows).where("reason is not null and found is not null").select("export_id", "turn_no", F.lit(True).alias("cut"))
    both = alone.join(cut, ["export_id", "turn_no"], "full")
    none = F.array().cast("array<string>")
    found = F.coalesce("found", none)
    found = F.concat(found, F.when(F.col("cut") & ~F.array_contains(found, "empty"), F.array(F.lit("truncated"))).otherwise(none))
    ordered = F.filter(F.array(*map(F.lit, RULES)), lambda r: F.array_contains(F.col("all_found"), r))
    return both.withColumn("all_found", found).select("export_id", "turn_no", F.get(ordered, F.lit(0)).alias("defect"), ordered.alias("triggered"))


def cut_turns(chats: DataFrame) -> DataFrame:
    """``(export_id, turn_no, image_source)`` of every turn that was cut off: human turns, and answers whose defect that is.

    An answer that only repeats its question or declines isn't cut, whatever its end looks like.
    """
    rows = materialise(examine(chats))
    cut = truncation.cut_values(rows).where("reason is not null").select("export_id", "turn_no", "image_source")
    before = F.array(*map(F.lit, RULES[: RULES.index("truncated")]))
    return cut.join(rows.where("found is not null and n_chars is null").where(F.arrays_overlap("found", before)).select("export_id", "turn_no"), ["export_id", "turn_no"], "left_anti")
