import random
import time

import pytest
from pyspark.sql import functions as F

from lumenweave import session
from lumenweave.llm import pairs as P
from lumenweave.llm import truncation as T


@pytest.mark.parametrize("question, answer, rules", [
    ("What is it?", None, ["empty"]), ("What is it?", "  \n", ["empty"]), ("What is it?", "Answer: \n", ["empty"]), ("What is it?", "<image>", ["empty"]), ("What is it?", "​", ["empty"]), ("What is it?", "...", ["empty"]),
    ("What is it?", "A", []), ("What is it?", "No", []), ("What is it?", "(B)", []), ("What is it?", "A cat on the mat.", []),
    ("What is the colour of the cat?", "what is the colour of the cat", ["copied"]), ("What is the colour of the cat?", "You asked: What is the colour of the cat?", ["copied"]), ("What is the the cat doing?", "Question: What is the cat doing?", ["copied"]),
    ("Which is right?\nA. The cat sleeps on the mat.\nB. The dog runs after the ball.", "A. The cat sleeps on the mat.", []), ("Is there a cat on the mat?", "There is a cat sleeping on the mat.", []),
    ("What is it?", "I'm sorry, but I can't help with that.", ["refusal"]), ("What is it?", "As an AI model, I'm unable to view images.", ["refusal"]), ("What is it?", "No, I will not describe the man.", ["refusal"]), ("What is it?", "i cant assist with this request", ["refusal"]),
    ("Was ist das auf dem Tisch?", "Es tut mir leid, aber dabei kann ich nicht helfen.", ["refusal"]), ("Que voit-on dans la rue?", "Je suis désolé, mais je ne peux pas répondre à cette question.", ["refusal"]), ("¿Qué es lo que hay en la mesa?", "Lo siento, pero no puedo ayudar con eso.", ["refusal"]),
    ("What does it say?", 'The sign says "Sorry, we can\'t help after six", signed Bob.', []), ("What is the name?", "The name cannot be made out, but the man wears a hat.", []), ("How old is it?", "Its age is impossible to tell from a photo.", []),
    ("What is the man doing?", "Der Mann sitzt auf dem Stuhl und liest die Zeitung.", ["language"]), ("What is the man doing?", "На картинке видна большая лопата.", ["language"]), ("¿Dónde está la chaqueta que lleva?", "The jacket is on the chair in the kitchen.", ["language"]),
    ("How do you say lamp in French?", "En français, on dirait « la lampe » ou « une lampe ».", []), ("Was ist das?", "Das ist eine Lampe.", []), (None, "The cat is on the mat.", []),
])
def test_rules(question, answer, rules):
    assert P.rules_of(question, answer) == rules


NOUNS = "basket lantern bicycle umbrella curtain fountain carpet blanket trumpet ladder".split()
PLACES = "kitchen garden station harbour market library".split()


def _corpus(rng, n=1500):
    def sentence():
        a, b, c = rng.choice(NOUNS), rng.choice(NOUNS), rng.choice(PLACES)
        return rng.choice([f"The {a} stands beside the {b} in the {c}.", f"There is a shiny {a} under the {b}, which looks heavy.", f"Somebody has left an old {a} next to the {b} of the {c}.", f"On the floor of the {c} lies a {a}.", f"In the {c}, the {a} leans on the {b}."])

    chats, cut = [], set()
    for i in range(n):
        q = f"What is next to the {rng.choice(NOUNS)} in the {rng.choice(PLACES)}?"
        a = rng.choice([sentence(), f"{sentence()} {sentence()}", f"A {rng.choice(NOUNS)} and a {rng.choice(NOUNS)}", rng.choice(NOUNS).title(), "Yes", f"The {rng.choice(NOUNS)} beside the {rng.choice(NOUNS)}"])
        if len(a.split()) > 7 and rng.random() < 0.1:
            at = rng.randint(12, len(a) - 14)
            while not (a[at - 1].isalpha() and a[at].isalpha()):
                at -= 1
            a = a[:at] + rng.choice(["", "", "...", "…"])
            cut.add((i, 1))
        chats.append((i, "s" if i % 2 else "S/", [("human", q), ("GPT ", a)]))
    return chats, cut


SCHEMA = "export_id bigint, image_source string, conversations array<struct<from string, value string>>"


def test_cuts(spark):
    chats, cut = _corpus(random.Random(3))
    odd = [(9000, None, None), (9001, "s", []), (9002, "s", [("human", None), ("gpt", None), (None, "x")]), (None, "s", [("human", "q"), ("gpt", "a")]), chats[5], (9003, "s", [("gpt", "The answer without a question stands alone in the kitchen.")])]
    df = spark.createDataFrame([(*r, "clash") for r in chats + odd], SCHEMA + ", turn_no string")
    got = {(r["export_id"], r["turn_no"]) for r in P.cut_turns(df).collect()}
    right = len(got & cut)
    assert right / len(cut) > 0.9 and right / len(got) > 0.95, (len(cut), len(got), right)
    rows = P.defects(df).collect()
    assert len({(r["export_id"], r["turn_no"]) for r in rows}) == len(rows)
    found = {(r["export_id"], r["turn_no"]): r for r in rows}
    assert {k for k, r in found.items() if r["defect"] == "truncated"} == got and found[(9002, 1)]["triggered"] == ["empty"]
    assert P.defects(df.limit(0)).count() == 0 and P.cut_turns(df.limit(0)).count() == 0


def test_cuts_without_broadcasts(spark, monkeypatch):
    chats, _ = _corpus(random.Random(5), 300)
    df = spark.createDataFrame(chats, SCHEMA)
    got = [sorted(map(tuple, P.cut_turns(df).select("export_id", "turn_no").collect()))]
    monkeypatch.setattr(session, "small", lambda *a, **k: False)
    got.append(sorted(map(tuple, P.cut_turns(df).select("export_id", "turn_no").collect())))
    assert got[0] == got[1] != []


def test_same_cuts_in_a_tenth_of_the_corpus(spark):
    chats, _ = _corpus(random.Random(6), 3000)
    df = spark.createDataFrame(chats, SCHEMA)
    whole, part = ({(r["export_id"], r["turn_no"]) for r in P.cut_turns(rows).collect()} for rows in (df, df.where("export_id < 300")))
    whole = {k for k in whole if k[0] < 300}
    assert len(whole & part) >= 0.9 * len(whole | part)


def test_bounds_of_shares(spark):
    got = spark.createDataFrame([(0, 0), (0, 50), (50, 50), (1, 4)], "part int, n int").select(T.bound(F.col("part"), F.col("n"), -1), T.bound(F.col("part"), F.col("n"), 1)).collect()
    assert tuple(got[0]) == (0, 1) and got[1][0] == pytest.approx(0) and got[1][1] == pytest.approx(1 / 51) and got[2][0] == pytest.approx(50 / 51) and got[3][0] < 0.25 < got[3][1]


def test_open_ends():
    assert T._open_pair('It says "No') and T._open_pair("It is (so") and T._open_pair("First,") and not T._open_pair('It says "No".')
    c = T.Collector()
    c.add(1, 0, None, "<image>\nOne two. Three four")
    c.add(2, 0, None, "Done.")
    c.add(3, 0, None, "...")
    tails = c.batch_rows()
    assert [(t[0], t[5], t[7], t[8], t[9]) for t in tails] == [(1, False, "four", "three", ["three", "four"])]
    batch = next(c.counts())
    rows = {(a, b): (n, e) for a, b, n, e in zip(*(batch.column(i).to_pylist() for i in range(10, 14)))}
    assert rows[("one", "two")] == (1, 1) and rows[("", "three")] == (1, 0) and ("three", "four") not in rows and rows[("", None)] == (2, 1) and rows[("done", None)] == (1, 1)


def test_one_word_after_other_text(spark):
    first, whole = "The basket stands beside the lantern in the kitchen.", "Which is right?\nA. The lantern stands in the garden.\nB. "
    cut = {"a": f"{first} The", "b": f"{first}\nThere", "c": f"{first}\nC. A", "d": f"{first}\n(C) The", "e": f"{first} A"}
    complete = ["A", "b", "The", "Yes", "The lantern is B", "The lantern is A", "Answer:\nA", f"{first}\nLantern", "A lantern.\nA basket.\nYes"]
    chats, _ = _corpus(random.Random(3))
    chats += [(7000 + i, "s", [("human", f"{whole}The basket leans on the ladder."), ("gpt", "AB"[i % 2] + ".")]) for i in range(300)]
    odd = [(8000 + i, "s", [("human", "What is it?"), ("gpt", a)]) for i, a in enumerate([*cut.values(), *complete])] + [(8100, "s", [("human", whole + "The"), ("gpt", "A")])]
    got = {(r["export_id"], r["turn_no"]) for r in P.cut_turns(spark.createDataFrame(chats + odd, SCHEMA)).where("export_id >= 8000").collect()}
    assert got == {(8000 + i, 1) for i in range(len(cut))} | {(8100, 0)}


@pytest.mark.parametrize("answer", ["Muž, který stojí před domem, nese košík a není sám.", "Masanın üzerinde bir lamba ve bir sepet var, bu çok eski.", "Manden står ved siden af huset og har ikke noget i hånden.", "Kuvassa on mies, joka istuu pöydän vieressä.", "A férfi egy szék mellett áll, és nem néz ide.", "Omul care este lângă casă ține un coș și o lampă pentru copil."])
def test_answers_in_more_languages(answer):
    assert P.rules_of("What is the man next to the house doing?", answer) == ["language"]
    assert P.rules_of(answer, answer.replace(",", " ").replace("a", "a ", 1) + " lampa 7") in ([], ["copied"])


SORRY = "Thank you very much for your question about the picture that you have sent. "
ASKED = "What is the man in the long green coat doing beside the old stone fountain in the middle of the market?"


@pytest.mark.parametrize("question, answer, rules", [
    (ASKED, f"{SORRY}{SORRY}I am very sorry, but I can't help with that.", ["refusal"]),
    (ASKED, f"{ASKED} I apologise. {SORRY} {'Unfortunately, ' * 5}I am not able to assist with this.", ["refusal"]),
    (ASKED, f"{'Sorry, ' * 21}that is something I cannot help with.", ["refusal"]),
    (ASKED, "He mends a net. A boy holds the other end of it. Two women carry baskets past them. Somebody says that I can't help. A dog sleeps near the wall.", []),
    (ASKED, f"{' ' * 50}Answer: ", ["empty"]), (ASKED, f"{'- ' * 30}Question: {ASKED}", ["copied"]),
])
def test_whole_answers(question, answer, rules):
    assert P.rules_of(question, answer) == rules


@pytest.mark.parametrize("text", ["ich kann nicht ", "i can't really ", "as an ai ", "no puedo ", "je ne peux ", "I can't help. ", "kann ich nicht\n"])
def test_refusals_take_no_long_time(text):
    began = time.process_time()
    P.rules_of("What is it?", text * (200_000 // len(text)))
    assert time.process_time() - began < 3


@pytest.mark.parametrize("question, answer, rules", [
    ("Wat ligt er op de tafel?", "Het spijt me, maar daar kan ik niet mee helpen.", ["refusal"]), ("Wat ligt er op de tafel?", "Helaas kan ik deze vraag niet beantwoorden.", ["refusal"]), ("Wat ligt er op de tafel?", "Ik moet weigeren.", ["refusal"]), ("Wat ligt er op de tafel?", "De lamp staat niet op de tafel.", []),
    ("Co leży na stole?", "Przykro mi, ale nie mogę w tym pomóc.", ["refusal"]), ("Co leży na stole?", "Niestety nie jestem w stanie odpowiedzieć na to pytanie.", ["refusal"]), ("Co leży na stole?", "Muszę odmówić.", ["refusal"]), ("Co leży na stole?", "Lampa nie leży na stole.", []),
    ("Vad står på bordet?", "Tyvärr kan jag inte hjälpa till med det.", ["refusal"]), ("Vad står på bordet?", "Jag kan inte svara på frågan.", ["refusal"]), ("Vad står på bordet?", "Jag måste avböja.", ["refusal"]), ("Vad står på bordet?", "Lampan står inte på bordet.", []),
])
def test_refusals_in_dutch_polish_and_swedish(question, answer, rules):
    assert P.rules_of(question, answer) == rules
