"""Problems 1 and 8."""

import random

import pytest
from pyspark.sql import functions as F

from parlance.llm import defects as D
from parlance.llm import leaks, wording

# --- 8: leaks

WORDS = [f"w{i}" for i in range(400)]


def brute(docs, items, n):
    grams = {}
    for i, t in items:
        w = (t or "").split()
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = set()
    for d, t in docs:
        w = (t or "").split()
        for k in range(len(w) - n + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + n]), ())}
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices(WORDS[:60] if i % 2 else WORDS, k=rng.randrange(5, 60)))) for i in range(60)] + [(90, None), (91, ""), (92, "a a a a a a a a a a a a a a a a"), (93, "w1 " * 13)]
    docs = []
    for d in range(300):
        w = rng.choices(WORDS, k=rng.randrange(0, 120))
        if d % 3 == 0:
            t = (rng.choice(items)[1] or "").split()
            k = rng.randrange(max(1, len(t) - 8))
            at = rng.randrange(len(w) + 1)
            w[at:at] = t[k : k + rng.randrange(8, 25)]
        docs.append((d, " ".join(w)))
    docs += [(900, None), (901, ""), (902, " ".join(["a"] * 30)), (903, "w1 " * 200), (904, "w1 " * 12)]
    D_, I_ = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("t", F.lit(0)), spark.createDataFrame(items, "item_id bigint, text string").withColumn("pos", F.lit(0))
    got = [tuple(r) for r in leaks.leaked(D_, I_).collect()]
    want = brute(docs, items, 13)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 40
    assert set(map(tuple, leaks.leaked(D_, I_, phrase=9).collect())) == brute(docs, items, 9)


def test_leaks_in_other_characters(spark):
    item = "the quick brown fox jumps over that lazy dog while it rained again today café"
    docs = [(1, item.upper()), (2, item.replace("a", "а").replace("café", "café")), (3, item.replace(" ", " ​")), (4, item.replace("that", "тһат")), (5, "".join(chr(ord(c) + 0xFEE0) if "a" <= c <= "z" else c for c in item)), (6, item.replace("fox", "cat"))]
    found = leaks.leaked(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(7, item)], "item_id bigint, text string"))
    assert sorted(map(tuple, found.collect())) == [(d, 7) for d in (1, 2, 3, 4, 5)]


def test_phrases_and_proximity(spark):
    item = " ".join(f"q{i}" for i in range(30))
    w = item.split()
    docs = [(1, "x " * 5 + item), (2, " ".join(w[:14] + ["new"] + w[14:])), (3, " ".join(x for i, x in enumerate(w) if i % 5)), (4, "q0 q5 q9")]
    index = leaks.Index(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert sorted((r["doc_id"], r["doc_word"], r["item_word"], r["n_words"]) for r in index.phrases().collect()) == [(1, 5, 0, 30), (2, 0, 0, 14), (2, 15, 14, 16)]
    near = {r["doc_id"]: r["item_share"] for r in index.proximity().collect()}
    assert near[1] == 1.0 and near[2] == 1.0 and 4 not in near


def near_brute(docs, items, slack, share):
    out = {}
    for i, t in items:
        w = t.split()
        for d, u in docs:
            at = {}
            for k, x in enumerate(u.split()):
                at.setdefault(x, []).append(k)
            shifts = {}
            for k, x in enumerate(w):
                for s in {p - k + off for p in at.get(x, ()) for off in range(-slack, slack + 1)}:
                    shifts[s] = shifts.get(s, 0) + 1
            n = max(shifts.values(), default=0)
            if n and n / len(w) >= share:
                out[d, i] = n / len(w)
    return out


def test_proximity_equals_brute_force(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices(WORDS[:40] if i % 3 == 0 else WORDS, k=rng.randrange(1, 45)))) for i in range(60)] + [(90, "a " * 16), (91, "w1"), (92, " ".join(f"z{k}" for k in range(8)) + " w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14")]
    docs = []
    for d in range(250):
        w = rng.choices(WORDS, k=rng.randrange(0, 90))
        t = [x for x in rng.choice(items)[1].split() if rng.random() > 0.08 * (d % 7)]
        for _ in range(d % 4):
            t.insert(rng.randrange(len(t) + 1), "new")
        if d % 5 == 0:
            t = [x for k in range(0, len(t), 3) for x in rng.sample(t[k : k + 3], len(t[k : k + 3]))]
        at = rng.randrange(len(w) + 1)
        w[at:at] = t
        docs.append((d, " ".join(w)))
    docs += [(900, ""), (901, "a " * 30), (902, " ".join(f"w{k}" for k in range(3, 15)))]
    index = leaks.Index(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    for slack, share in ((4, 0.6), (1, 0.75)):
        got = [tuple(r) for r in index.proximity(slack, share).collect()]
        want = near_brute(docs, items, slack, share)
        assert len(got) == len({r[:2] for r in got}) and {(d, i): x for d, i, x in got} == want and len(want) > 60
    assert (902, 92) in near_brute(docs, items, 4, 0.6)


def test_proximity_without_any_exact_stretch(spark):
    w = [f"q{i}" for i in range(30)]
    docs = [(3, " ".join(x for i, x in enumerate(w) if i % 5)), (4, "q0 q5 q9"), (5, " ".join("odd" if i % 5 == 0 else x for i, x in enumerate(w)))]
    index = leaks.Index(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, " ".join(w)), (2, "q1 q2 q3 q4 absent")], "item_id bigint, text string"))
    assert {tuple(r) for r in index.proximity().collect()} == {(3, 1, 0.8), (5, 1, 0.8), (3, 2, 0.8), (5, 2, 0.8)}


def test_leaks_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert leaks.leaked(docs.limit(0), items).count() == leaks.leaked(docs, items.limit(0)).count() == leaks.leaked(docs, items).count() == 0


# --- 1: broken pairs

NAMES = [a + b for a in ("Kor", "Mel", "Tan", "Vor", "Lis") for b in ("dan", "vik", "sa", "mor", "tel", "rin")]
THINGS = ["table", "lamp", "violin", "basket", "ladder", "kettle", "curtain", "garden"]
TEMPLATES = {
    "en": ("{a} wants to thank {b} for the {t} and for the soup.", "After the storm, {a} left the {t} with {b} in the hall.", "Did you hear that {a} gave away a {t} last weekend?", "I felt tired because the {t} fell off a shelf, so {a} called {b}.", "It took my brother nine days to trust {a} with the {t}."),
    "de": ("{a} möchte heute mit {b} die Tür reparieren.", "Ich war im März ganz nervös, weil {a} nicht mit dem Auto kam.", "Wenn du nach dem Essen zu {b} kommst, probieren wir die Suppe."),
    "fr": ("{a} n'aime pas vendre le carnet sans demander à {b}.", "Je me sentais triste avant le dîner, car {a} ne voulait pas rester chez nous.", "Est-ce que {a} a laissé la lettre dans le jardin avec {b} ?"),
}


def dialogue(rng, lang, n):
    return [rng.choice(TEMPLATES[lang]).format(a=rng.choice(NAMES), b=rng.choice(NAMES), t=rng.choice(THINGS)) for _ in range(n)]


def some_prompts(seed=2, n=1_200):
    rng = random.Random(seed)
    return [dialogue(rng, rng.choice(("en", "en", "en", "de", "fr")), rng.randrange(2, 7)) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return D.fit(some_prompts())


def test_held_out_accuracy(model):
    rng = random.Random(3)
    prompts, answers, truth = [], [], []

    def add(p, a, d):
        prompts.append(p)
        answers.append(a)
        truth.append(d)

    for _ in range(150):
        lang = rng.choice(("en", "en", "de", "fr"))
        other = rng.choice([x for x in TEMPLATES if x != lang])
        p, a = dialogue(rng, lang, 3), dialogue(rng, lang, 2)
        add(p, a, None)
        add(p, [a[0], a[1][:-1]], None)
        cut = a[1][:-1].split(" ")
        add(p, [a[0], " ".join(cut[: len(cut) // 2])], "truncated")
        add(p, [rng.choice((p[-1].upper(), "You said: " + p[-1], p[-1]))], "copied")
        add(p, dialogue(rng, other, 2), "other_language")
        add(p, ["I'm sorry, but I cannot assist with rewriting this dialogue."], "refusal")
        if lang == "en":
            add(p, ["I'm sorry, but I cannot bring the ladder today."], None)
        add(p, [rng.choice(("", "N/A", "…", "​"))], "empty")
    got = D.judge(prompts, answers, model)
    wrong = [(t, g, a) for t, g, a in zip(truth, got, answers) if t != g]
    assert len(wrong) < 0.03 * len(truth), wrong[:10]


def test_refusals_that_name_no_task(model):
    rng = random.Random(4)
    bare = ["I'm sorry, but I can't help with that.", "I cannot comply.", "As an AI, I am unable to do this.", "I must decline to produce the text.", "No puedo ayudar con eso.", "Je ne peux pas vous aider.", "Ich kann dabei nicht helfen."]
    held_out = ["I apologize, but I'm not able to help with this.", "Sorry, I can't do that.", "As an AI model, I cannot assist you with this.", "Unfortunately, I have to refuse.", "Lo siento, no puedo hacer esto.", "Désolé, je ne peux pas vous aider avec ça.", "Leider kann ich das nicht tun.", "Извините, я не могу это сделать."]
    clean = ["I'm sorry to hear that.", "I can't help with the lamp today.", "Sorry, I cannot lend you the violin.", "I'm sorry, but Korsa cannot come.", "I must decline the basket, my flat is too small.", "I can't believe that.", "No puedo llevar la mesa.", "Ich kann nicht schlafen."]
    prompt = lambda: dialogue(rng, "en", 3)
    found = lambda xs: D.judge([prompt() for _ in xs], [[x] for x in xs], model)
    missed = [x for x, d in zip(bare, found(bare)) if d != "refusal"]
    assert not missed
    missed = [x for x, d in zip(held_out, found(held_out)) if d != "refusal"]
    assert len(missed) <= 1, missed
    wrong = [x for x, d in zip(clean, found(clean)) if d == "refusal"]
    assert not wrong


def apart(parts):
    """Two thirds of the parts of each language, and the others."""
    return tuple({lang: tuple(x for i, x in enumerate(xs) if (i % 3 == 1) == held) or xs for lang, xs in parts.items()} for held in (False, True))


def test_refusals_in_parts_that_were_not_learnt(monkeypatch):
    """Fitted on two thirds of the grammar's parts, and held against refusals and declined things made of the others alone."""
    learnt, other = {}, {}
    for name in ("OPENINGS", "UNWILLING", "ASKED_FOR", "OUTRIGHT", "ENDINGS", "DECLINED", "EVERYDAY", "SMALL_TALK", "THINGS"):
        learnt[name], other[name] = apart(getattr(wording, name))
    for name, parts in learnt.items():
        monkeypatch.setattr(wording, name, parts)
    m = D.fit(some_prompts())
    for name, parts in other.items():
        monkeypatch.setattr(wording, name, parts)
    rng = random.Random(6)
    refused = [wording.refusal(rng, "en") for _ in range(400)]
    talk = [wording.declined(rng, "en", THINGS, NAMES) for _ in range(200)] + [wording.small_talk(rng, "en", NAMES) for _ in range(100)] + [dialogue(rng, "en", 1)[0] for _ in range(900)]
    prompts = [dialogue(rng, "en", 3) for _ in refused + talk]
    found = [d == "refusal" for d in D.judge(prompts, [[x] for x in refused + talk], m)]
    hits, wrong = sum(found[: len(refused)]), sum(found[len(refused) :])
    assert hits / len(refused) >= 0.9 and hits / (hits + wrong) >= 0.9, (hits, wrong)
    # of the shorter lists of other languages less is left to learn from
    refused = [wording.refusal(rng, rng.choice(("de", "fr", "es", "ru"))) for _ in range(200)]
    hits = D.judge([dialogue(rng, "en", 3) for _ in refused], [[x] for x in refused], m).count("refusal")
    assert hits / len(refused) >= 0.6, hits


#: Written for this test: none of them is a sentence of the grammar.
FRESH = (
    "I don't think it's a good idea for me to script those lines.", "This lies outside the scope of what I'm meant to output.", "My developers have barred me from composing such passages.", "Writing in that style isn't permitted under our terms.",
    "Answering would break the rules I operate under.", "We are unable to generate a completion for that.", "It's against policy for me to draft this.", "Producing that would conflict with my values.", "I am restricted from outputting such lines.",
    "Sorry, that is not content I generate.", "I'm sorry, I can't assist with that.", "As an AI developed to be helpful, I can't pretend to be these people.", "I won't write hurtful lines.", "I can't make this dialogue less coherent.", "I'm not going to write a worse answer on purpose.",
    "Sorry, but I will not degrade this conversation.", "I'm afraid I can't comply with that.", "I cannot do that.", "I'm not able to help with this.", "My safety rules prevent me from answering.",
)


def test_refusals_in_fresh_words(model):
    rng = random.Random(9)
    found = D.judge([dialogue(rng, "en", 3) for _ in FRESH], [[x] for x in FRESH], model)
    assert found.count("refusal") >= 0.9 * len(FRESH), [x for x, d in zip(FRESH, found) if d != "refusal"]


OTHER_TONGUES = {
    "nl": "Dat had ik nooit gedacht. Misschien kunnen we later nog even langsgaan.",
    "pl": "Tego się nie spodziewałem. Może później jeszcze do niego zadzwonimy.",
    "sv": "Det hade jag inte trott. Kanske kan vi ringa honom lite senare.",
    "tr": "Bunu hiç beklemiyordum. Belki onu biraz sonra ararız.",
    "pt": "Nossa, eu não esperava por essa. Talvez a gente possa ligar mais tarde.",
    "zh": "真没想到会这样。也许我们晚点可以给他打个电话。",
    "it": "Questa non me l'aspettavo. Forse possiamo chiamarlo più tardi.",
    "de": "Das hätte ich nicht gedacht. Vielleicht rufen wir ihn später an.",
    "fr": "Je ne m'y attendais pas. On pourrait peut-être l'appeler plus tard.",
    "es": "Esto sí que me sorprende. Quizás podamos llamarlo más tarde.",
    "ru": "Вот так новость. Может быть, позвоним ему позже.",
    "ja": "それは意外ですね。後で電話してみましょうか。",
    "ko": "그건 생각도 못 했네요. 나중에 전화해 볼까요?",
    "el": "Δεν το περίμενα αυτό. Ίσως μπορούμε να τον πάρουμε αργότερα.",
    "ar": "لم أكن أتوقع ذلك. ربما نتصل به لاحقا.",
    "hu": "Erre nem számítottam. Talán később felhívhatjuk.",
    "fi": "Tätä en odottanut. Ehkä voimme soittaa hänelle myöhemmin.",
    "ro": "Nu mă așteptam la asta. Poate îl sunăm mai târziu.",
    "cs": "To jsem nečekal. Možná mu můžeme zavolat později.",
    "hi": "मैंने ऐसा नहीं सोचा था। शायद हम उसे बाद में बुला सकते हैं।",
}


def test_languages_of_sentences_that_were_not_learnt(model):
    rng = random.Random(7)
    own = ["Well, that is a surprise. Maybe we could ring him a bit later.", "Honestly? Never saw it coming.", "He says “hasta luego” whenever he goes.", "Great idea, Velmor!", "Café au lait for me, please.", "Okidoki, see you Friday at noon, bring snacks."]
    got = dict(zip(OTHER_TONGUES, D.judge([dialogue(rng, "en", 3) for _ in OTHER_TONGUES], [[t] for t in OTHER_TONGUES.values()], model)))
    missed = [lang for lang, d in got.items() if d != "other_language"]
    assert len(missed) <= 0.1 * len(got), missed
    assert "other_language" not in D.judge([dialogue(rng, "en", 3) for _ in own], [[t] for t in own], model)
    # the other way round, and half and half
    assert D.judge([dialogue(rng, "de", 4)], [["We could ring him a bit later, if that is fine with you."]], model) == ["other_language"]
    assert D.judge([dialogue(rng, "en", 3)], [[OTHER_TONGUES["nl"], *dialogue(rng, "en", 3)]], model) == [None]


def test_words_for_nothing_and_short_replies(model):
    nothing = ["(no answer provided)", "NULL", "[blank]", "keine Antwort", "sin respuesta", "aucune réponse", "[REDACTED]", "undefined", "<no reply>", "回答なし", "нет ответа", "(leer)", "[content removed]", "No content", "no_output", "NaN", "{response missing}", "*empty message*"]
    said = ["Nothing.", "No.", "None of them.", "Nobody knows.", "Yes.", "I deleted it.", "No answer yet.", "Okay, sure.", "Thanks!", "Korsa did.", "In the garden.", "Only the lamp.", "Who, me?", "Not a word.", "Fine by me."]
    found = D.judge([["What did you find in the drawer?"]] * len(nothing + said), [[x] for x in nothing + said], model)
    hits, wrong = found[: len(nothing)].count("empty"), found[len(nothing) :].count("empty")
    assert hits >= 0.9 * len(nothing) and wrong <= 0.1 * hits, list(zip(nothing + said, found))


def test_a_model_is_kept(spark, model, tmp_path):
    D.save(spark, model, str(tmp_path / "model"))
    again = D.load(spark, str(tmp_path / "model"))
    rng = random.Random(8)
    prompts, answers = [dialogue(rng, "en", 3) for _ in range(40)], [rng.choice((dialogue(rng, "en", 1), ["N/A"], ["I can't write that."], [OTHER_TONGUES["pl"]])) for _ in range(40)]
    assert D.judge(prompts, answers, again) == D.judge(prompts, answers, model)


def test_answers_that_say_nothing(model):
    found = lambda xs: D.judge([["Did you find the lamp?"]] * len(xs), [[x] for x in xs], model)
    assert set(found(["", " \n", "​", "...", "N/A", "[no response]", "<empty>", '""', "null"])) == {"empty"}
    assert "empty" not in found(["No.", "N/A is what the form said.", "Null and void, as my uncle says.", "是"])
    assert D.judge([["What did you find?"]] * 2, [["N/A", "Korsa has the lamp."], ["", "N/A", "​"]], model) == [None, "empty"]


def test_exact_checks():
    p = D.read_prompts([["one two three four five six", "seven eight nine ten eleven twelve thirteen"]])[0]
    assert D.copy_distance(p, "seven eight nine ten eleven twelve thirteen".split())[1] == 0
    assert D.copy_distance(p, "you said seven eight nine ten eleven twelve thirteen".split())[1] == 0
    assert D.copy_distance(p, "one two three four five six seven eight nine ten eleven twelve thirteen".split())[1] == 0
    assert D.copy_distance(p, "seven eight nine ten eleven twelve warm".split())[1] == 1
    assert D.copy_distance(p, "something else entirely that nobody said before".split())[0] > 0.5
    assert D.unended("All done.") is None and D.unended("Done? \U0001f642") is None and D.unended("“Done.”") is None
    assert D.unended("First. Then we") == "Then we"


def test_any_rows_are_judged(spark, model):
    schema = "record_id string, field string, prompt array<string>, answer array<string>"
    ok = "Korsa wants to thank Vikmor for the lamp and for the soup."
    rows = [("a", "f", ["hi there you"], None), ("a", "f", ["hi there you"], None), ("b", "f", None, [ok]), ("c", "f", [], []), ("d", "f", [None], [None, ""]), ("e", "f", [ok], [ok]), ("f", None, ["x"], [ok * 3000]), (None, "f", ["x"], [" "])]
    df = spark.createDataFrame(rows, schema).withColumn("defect", F.lit("clash"))
    got = {(r["record_id"], r["field"]): r["defect"] for r in D.defective(df, model).collect()}
    assert got == {("a", "f"): "empty", ("c", "f"): "empty", ("d", "f"): "empty", ("e", "f"): "copied", (None, "f"): "empty"}
    assert D.defective(df.limit(0), model).count() == 0


def test_fitting_on_nothing():
    blank = D.fit([])
    assert D.judge([["a"]], [["b c d."]], blank) == [None] and D.judge([["a b"]], [[""]], blank) == ["empty"]
    assert D.fit([["only one message here."]]).weights.shape[1] == len(D.DEFECTS)
