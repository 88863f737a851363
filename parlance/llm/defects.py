"""Problem 1: broken prompt and response pairs, by a multi-label linear classifier on hashed n-grams and pair features.

Prompts hold clean dialogue, so a bounded sample of them gives clean pairs (a prompt's beginning and its continuation), and
from these come synthetic defects: emptied, truncated, copied, swapped with another language's answer, and refused. One
logistic regression for each defect is fitted on the driver, with a threshold calibrated on pairs held out from fitting.
All rows are then scored in Arrow batches. What the classifier proposes is held against those parts of the defect's
definition that can be counted, and each answer gets the first of its defects in the order of DEFECTS.

Which wordings refuse, or stand for "nothing", is learnt from the grammar in ``wording``; languages are told apart by the
classifier of ``languages``. A fitted model can be kept (``save``, ``load``).

Null and empty message arrays, null messages and null contents count as empty. A null prompt can't be copied and has no
language. Texts of any length are read whole. Repeated rows come out once.
"""

from __future__ import annotations

import pickle
import random
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.session import ship

from . import wording
from .languages import LANGUAGES, SEEDS, Languages, learn

DEFECTS = ("empty", "refusal", "copied", "other_language", "truncated")
#: Hashed features: of pairs, which every label has, then n-grams of an answer that is one short message, of how an answer
#: begins, and of how it ends.
PAIR, LONE, BEGIN, END = 1 << 8, 1 << 15, 1 << 17, 1 << 18  # BEGIN: see opening_features
DIMENSIONS = PAIR + LONE + BEGIN + END
#: Most rows whose prompts are taken for fitting, from each table.
SAMPLE_ROWS = 800
#: Words that a message which stands for "nothing" has at most.
FEW_WORDS = 5

#: Stands between messages on their way to Python.
BETWEEN = "\x1e"
WORD = re.compile(r"[^\W_]+")
MARKED = re.compile(r"[^\W_]+|[.?!。？！]")
TOKEN = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*|[,;:–—-]")
INVISIBLE = re.compile("[­​-‏⁠﻿️]")
ENDING = re.compile(r"[.?!…。？！][\s\"'”’»)\]*_|>]*$")
AFTER_TEXT = re.compile(r"[^\w.?!…。？！\"'”’»)\],;:–—-]+$")
SENTENCE = re.compile(r"(?<=[.?!…。？！])[\"'”’»)]*\s+|(?<=[。？！])|\n+")

_NOT_LATIN = re.compile("[Ͱ-ӿ؀-ۿ぀-鿿가-힯]")
BRACKETED = re.compile(r"^\s*[\[({<*\"“_#/-].*[\])}>*\"”_/-]\s*$", re.S)
LAST_MARK = re.compile(r"([.?!…。？！]+)\s*$")

INTRODUCTIONS = ("You said: ", "To repeat: ", "The question was: ", "So, ", "Well, ", "Oh! ", "Okay. ", "Right: ", "I repeat: ", "As you said, ", "You asked: ", "Here it is again: ", "Hmm, ")
REPLIES = ("You mention “{q}”. ", "“{q}” – I had not thought of it that way. ", "Why do you say “{q}”? ", "As for “{q}”: ", "“{q}”? ")
DANGLING = (" – and then my", ", because the", " – which is why", " and then my", ", but", " so that", ", and the", " which", ": the", " when we", ", although it")


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray
    vocabulary: frozenset[str]
    template: frozenset[str]
    languages: Languages


def texts(messages) -> list[str]:
    return [] if messages is None else [(t or "") if isinstance(t, str) or t is None else str(t) for t in messages]


def parts(joined: str | None) -> list[str]:
    return joined.split(BETWEEN) if joined else []


def visible_words(text: str) -> list[str]:
    return WORD.findall((text if text.isascii() else INVISIBLE.sub("", text)).lower())


class Prompt(NamedTuple):
    """A prompt's messages, the words of each, and its longer words."""

    messages: list[str]
    said: list[list[str]]
    words: set[str]


def read_prompts(prompts: list[list[str]]) -> list[Prompt]:
    """Prompts of several answers are read once."""
    known: dict[str, Prompt] = {}
    out = []
    for p in prompts:
        key = BETWEEN.join(p)
        if key not in known:
            said = [visible_words(t) for t in p]
            known[key] = Prompt(p, said, {w for ws in said for w in ws if len(w) > 3})
        out.append(known[key])
    return out


class Foreign(NamedTuple):
    """share: of an answer's letters, those in sentences of another language than the prompt's, among those that can be told. lead: by how much per letter the best other language is ahead."""

    share: float = 0.0
    lead: float = 0.0


def _told(ahead: float, letters: int) -> bool:
    return ahead >= max(25.0, 0.5 * letters)


def foreign(prompts: list[Prompt], answers: list[list[str]], said: list[list[list[str]]], m: Languages) -> list[Foreign]:
    """For each pair how foreign the answer is; ``said``: the words of its messages.

    Messages in which the prompt's language is far ahead are taken whole; sentences are looked at where another is near.
    """
    homes: dict[int, int | None] = {}
    keys = list(map(id, prompts))
    fresh = dict(zip(keys, prompts))
    for key, s in zip(fresh, m.scores([[w for ws in p.said for w in ws] for p in fresh.values()])):
        second, top = np.sort(s)[-2:]
        homes[key] = int(s.argmax()) if _told(float(top - second), 0) else None
    where = [(r, i) for r, ws in enumerate(said) for i in range(len(ws)) if homes[keys[r]] is not None]
    got = m.scores([said[r][i] for r, i in where])
    known, other, lead, letters = (np.zeros(len(said)) for _ in range(4))
    near: list[tuple[int, str]] = []
    for (r, i), s in zip(where, got):
        home = homes[keys[r]]
        size = sum(map(len, said[r][i]))
        rest = s.copy()
        rest[home] = -np.inf
        ahead = float(s[home] - rest.max())
        letters[r] += size
        lead[r] -= ahead
        if ahead >= 1.5 * size:
            known[r] += size
        else:
            near += [(r, x) for x in SENTENCE.split(answers[r][i]) if x]
    for (r, x), s in zip(near, m.scores([WORD.findall(x.lower()) for _, x in near])):
        home, size = homes[keys[r]], len(x)
        rest = s.copy()
        rest[home] = -np.inf
        ahead = float(s[home] - rest.max())
        if _told(abs(ahead), size):
            known[r] += size
            other[r] += size * (ahead < 0)
    return [Foreign(o / k if k else 0.0, x / n if n else 0.0) for o, k, x, n in zip(other, known, lead, letters)]


def copy_distance(prompt: Prompt, answer_words: list[str]) -> tuple[float, int]:
    """Least share of words that differ between the answer and the last messages of the prompt, and how many differ.

    Words at the answer's beginning that introduce the copy, up to four, aren't counted, if the copy has more than they.
    """
    n = len(answer_words)
    best = (1.0, n)
    if not n:
        return best
    tail: list[str] = []
    have = set(answer_words)
    for ws in reversed(prompt.said):
        tail = ws + tail
        t = len(tail)
        if t > n + 2:
            break
        if t < 0.6 * n - 4 or not t or len(have.intersection(tail)) < 0.6 * len(set(tail)):
            continue
        blocks = SequenceMatcher(None, tail, answer_words, autojunk=False).get_matching_blocks()
        intro = min(blocks[0].b, 4) if blocks[0].a == 0 and t > 4 else 0
        differ, i, j = 0, 0, intro
        for b in blocks:
            x, y = b.a - i, b.b - j
            differ += 1 if x == 1 and y == 2 else max(x, y)  # a word may become one with a hyphen
            i, j = b.a + b.size, b.b + b.size
        if differ / max(t, 1) < best[0]:
            best = (differ / max(t, 1), differ)
    if best[0] == 1.0 and n <= 3 and prompt.messages and _NOT_LATIN.search(prompt.messages[-1]):  # scripts without spaces
        a, b = "".join(answer_words), "".join(prompt.said[-1])
        if b and 0.6 < len(a) / len(b) < 1.6:
            same = sum(x.size for x in SequenceMatcher(None, b, a, autojunk=False).get_matching_blocks())
            best = (1 - same / max(len(a), len(b)), round((max(len(a), len(b)) - same) / 5))
    return best


def unended(text: str) -> str | None:
    """The last sentence of a text if it has no end mark, else None."""
    t = AFTER_TEXT.sub("", INVISIBLE.sub("", text))
    if not t or ENDING.search(t):
        return None
    return SENTENCE.split(t)[-1].lstrip("“\"'([«")


def _h(s: str) -> int:
    return crc32(s.encode("utf-8", "surrogatepass")) % PAIR


def _l(s: str) -> int:
    return PAIR + crc32(s.encode("utf-8", "surrogatepass")) % LONE


def _e(s: str) -> int:
    return PAIR + LONE + BEGIN + crc32(s.encode("utf-8", "surrogatepass")) % END


#: Which n-grams a label has beside the pair features.
OWN = {"empty": (PAIR, PAIR + LONE), "refusal": (PAIR + LONE, PAIR + LONE + BEGIN), "truncated": (PAIR + LONE + BEGIN, DIMENSIONS)}

#: Weight decay beside the default: refusals are to be told by many of their words, not by rare turns of phrase.
DECAY = {"refusal": 4e-5}
#: How far a rarer label's examples are weighed up.
MOST_WEIGHT = {"refusal": 4.0}
#: Share of the n-grams that are taken from half of the beginnings in fitting.
LOST = 0.3


def counts_for(defect: str, idx: np.ndarray) -> np.ndarray:
    """Which features a label has: short messages tell stand-ins, beginnings refusals, endings truncation, pair features tell all.

    A refusal may be in any language and of any length, so it is told by how it begins alone.
    """
    low, high = OWN.get(defect, (0, 0))
    pair = idx == _h("bias") if defect == "refusal" else idx < PAIR
    return pair | ((idx >= low) & (idx < high))


def ending_features(tail: str | None, m: Model) -> list[tuple[int, float]]:
    """How a text ends: n-grams of its last words, literal and by template, and the template from the sentence's beginning."""
    if tail is None:
        return [(_e("end:mark"), 3.0)]
    raw = TOKEN.findall(tail)
    if not raw:
        return [(_e("end:none"), 1.0)]
    kinds = []
    for i, w in enumerate(raw):
        low = w.lower()
        kinds.append(low if low in m.template else "#" if w[0].isdigit() else "C" if i and w[0].isupper() else "w")
    low = [w.lower() for w in raw[-3:]]
    out = [f"e1:{low[-1]}", f"e2:{' '.join(low[-2:])}", f"k1:{kinds[-1]}", f"k2:{' '.join(kinds[-2:])}", f"k3:{' '.join(kinds[-3:])}", f"k4:{' '.join(kinds[-4:])}", f"k6:{' '.join(kinds[-6:])}", f"all:{' '.join(kinds)}", f"s2:{' '.join(kinds[:2])}|{' '.join(kinds[-2:])}", f"s1:{kinds[0]}|{kinds[-1]}"]
    f = [(_e(x), 1.0) for x in out]
    last = raw[-1].lower()
    if last not in m.vocabulary and not last.isdigit():
        f.append((_e("end:unknown"), 2.0))
    if len(raw) < 3:
        f.append((_e("end:short"), 1.0))
    return f


def lone_features(text: str, words: list[str], asked: bool) -> list[str]:
    """A short message by itself: its words and letters, its case, brackets and end mark, and whether a question stands before it."""
    core = " ".join(words)
    bare = "".join(c for c in text if c.isalpha())
    case = "none" if bare.lower() == bare.upper() else "lower" if bare == bare.lower() else "upper" if bare == bare.upper() and len(bare) > 1 else "first" if bare[1:] == bare[1:].lower() else "mixed"
    mark = LAST_MARK.search(text)
    form = f"{'b' if BRACKETED.match(text) else '-'}|{mark[1][0] if mark else '-'}|{case}|{asked}"
    grams = {f"w:{w}" for w in words} | {f"v:{a} {b}" for a, b in zip(words, words[1:])} | {f"c:{x[i : i + n]}" for x in (f"^{''.join(words)}$",) for n in (2, 3, 4) for i in range(len(x) - n + 1)}
    return [f"={core}", f"={core}|{bool(mark)}", f"n:{len(words)}|{bool(mark)}", f"f:{form}", f"m:{bool(mark)}", f"b:{bool(BRACKETED.match(text))}", f"s:{'_' in text or '/' in text}", *grams]


def _row(f: list[tuple[int, float]], more: np.ndarray | None = None, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features of an example, 8 bytes each."""
    idx, val = zip(*f)
    idx, val = np.array(idx, np.int32), np.array(val, np.float32)
    return (idx, val) if more is None else (np.concatenate((idx, more)), np.concatenate((val, values)))


class _Hashes(dict):
    """A text's 64-bit hash, for n-grams of words; emptied when it grows past its bound."""

    def __missing__(self, x: str) -> int:
        if len(self) > 300_000:
            self.clear()
        raw = x.encode("utf-8", "surrogatepass")
        h = self[x] = crc32(raw) << 32 | crc32(raw[::-1])
        return h


_HASHES = _Hashes()
_ODD_NUMBERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _hashed(xs: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, xs), np.uint64, len(xs))


def opening_features(first: list[str], text: str, prompt_words: set[str], m: Model) -> tuple[np.ndarray, np.ndarray]:
    """How an answer begins: n-grams of its first message, and how many of its words are of the data's dialogues or of this one.

    Longer n-grams count less, so that wordings which were not learnt are told by their words.
    """
    own = [f"rp:{w[:6]}" for w in first]
    if _NOT_LATIN.search(text):
        t = "".join(first)
        own += [f"rc:{t[i : i + n]}" for n in (2, 3, 4) for i in range(len(t) - n + 1)]
    content = [w for w in first if len(w) > 3 and w not in m.template]
    things, mine = len(m.vocabulary.intersection(content)), len(prompt_words.intersection(content))
    own += [f"things:{min(things, 4)}", f"own:{min(mine, 3)}", f"length:{min(len(first) // 4, 8)}", f"t|o:{min(things, 2)}|{min(mine, 2)}"]
    h = _hashed(MARKED.findall((text if text.isascii() else INVISIBLE.sub("", text)).lower()))
    grams = (h, _hashed(own), h[:-1] * _ODD_NUMBERS[0] + h[1:], h[:-2] * _ODD_NUMBERS[1] + h[2:])
    idx = (np.concatenate(grams) * _ODD_NUMBERS[2] >> np.uint64(64 - 17)).astype(np.int32) + np.int32(PAIR + LONE)
    return idx, np.repeat(np.array([1.0, 1.0, 0.6, 0.4], np.float32), list(map(len, grams)))


def features(prompt: Prompt, answer: list[str], said: list[list[str]], far: Foreign, m: Model) -> tuple[tuple[np.ndarray, np.ndarray], dict]:
    """Hashed n-grams and pair features, and what the counted parts of the definitions need."""
    f = [(_h("bias"), 1.0)]
    talk = [i for i, ws in enumerate(said) if ws]
    few = all(len(ws) <= FEW_WORDS for ws in said)
    if not talk:
        f.append((_h("blank"), 4.0))
        return _row(f), {"talks": False, "few": True, "share": 0.0, "distance": (1.0, 0), "tail": None}
    f.append((_h(f"few:{few}"), 2.0))
    if few:
        asked = bool(prompt.messages) and AFTER_TEXT.sub("", prompt.messages[-1])[-1:] in ("?", "？")
        k = max(talk, key=lambda i: (len(said[i]), sum(map(len, said[i])), -i))  # if it says nothing, no shorter one does
        f.extend((_l(x), 1.0) for x in lone_features(answer[k], said[k], asked))
    f.append((_h(f"messages:{min(len(answer), 3)}"), 1.0))
    first = said[talk[0]]
    opening = opening_features(first, answer[talk[0]], prompt.words, m)
    distance = copy_distance(prompt, [w for ws in said for w in ws])
    f.append((_h("copy"), 4 * max(0.0, 1 - distance[0] / 0.3)))
    f.append((_h(f"copied:{min(int(distance[0] * 20), 8)}"), 2.0))
    f.append((_h("foreign"), 4 * far.share))
    f.append((_h(f"foreign:{int(far.share * 10)}"), 2.0))
    f.append((_h("lead"), max(-2.0, min(2.0, far.lead))))
    tail = unended(answer[-1])
    f.extend(ending_features(tail, m))
    return _row(f, *opening), {"talks": True, "few": few, "share": far.share, "distance": distance, "tail": tail}


def confirmed(defect: str, facts: dict) -> bool:
    """What of a defect's definition can be counted. Of refusals, and of which short messages stand for "nothing", the score decides."""
    if defect == "empty":
        return facts["few"]
    if defect == "copied":
        return facts["distance"][0] <= 0.15 or facts["distance"][1] <= 1
    if defect == "other_language":
        return facts["share"] > 0.5
    if defect == "truncated":
        return facts["tail"] is not None
    return facts["talks"]


def all_features(prompts: list[list[str]], answers: list[list[str]], m: Model) -> list[tuple[tuple[np.ndarray, np.ndarray], dict]]:
    said = [[visible_words(t) for t in a] for a in answers]
    read = read_prompts(prompts)
    return [features(p, a, ws, x, m) for p, a, ws, x in zip(read, answers, said, foreign(read, answers, said, m.languages))]


def _reformatted(rng: random.Random, text: str) -> str:
    k = rng.randrange(6)
    if k == 0:
        return text.upper()
    if k == 1:
        return text.lower()
    if k == 2:
        return rng.choice(INTRODUCTIONS) + text
    if k == 3:
        return f"“{text}”"
    if k == 4:
        return re.sub(r"[,.;:]", "", text)
    ws = text.split(" ")
    ws[rng.randrange(len(ws))] = rng.choice(("table", "warm", "seven", "quietly"))
    return " ".join(ws)


def _cut(rng: random.Random, text: str) -> str | None:
    """The text broken off within its last sentence, or with a clause begun after it."""
    if rng.random() < 0.12:
        return text.rstrip(".?!。！？… ") + rng.choice(DANGLING)
    parts = [s for s in SENTENCE.split(text) if s]
    if not parts or len(parts[-1]) < 12:
        return None
    last = parts[-1].rstrip(".?!。！？… \"”)")
    spaces = [i for i, c in enumerate(last) if c == " "]
    if rng.random() < 0.75 and spaces:
        at = rng.choice(spaces)
    else:
        at = rng.randrange(4, max(5, len(last) - 2))
        if last[at - 1] == " " or last[at] == " ":
            return None
    return " ".join(parts[:-1] + [last[:at].rstrip()])


def synthetic(prompts: list[list[str]], seed: int) -> tuple[list, np.ndarray, np.ndarray, Model]:
    """Features, labels, which labels count, and the model without weights, from clean prompts.

    The vocabulary holds the words of two prompts or more, so that words of one prompt alone are as unknown as words of
    rows that are not in the sample.
    """
    rng = random.Random(seed)
    tongue = learn([" ".join(p) for p in prompts])
    heard = tongue.scores([WORD.findall(" ".join(p).lower()) for p in prompts])
    by_language: dict[str, list[list[str]]] = {}
    counts: dict[str, Counter] = {}
    sentences: dict[str, list[str]] = {}
    met: Counter = Counter()
    named: Counter = Counter()
    langs = []
    for p, s in zip(prompts, heard):
        second, top = np.sort(s)[-2:]
        lang = LANGUAGES[int(s.argmax())] if _told(float(top - second), 0) else "?"
        langs.append(lang)
        by_language.setdefault(lang, []).append(p)
        here = set()
        for t in p:
            for x in SENTENCE.split(t):
                toks = TOKEN.findall(x)
                if toks:
                    sentences.setdefault(lang, []).append(x)
                    counts.setdefault(lang, Counter()).update({w.lower() for i, w in enumerate(toks) if not i or not w[0].isupper()})
                    here.update(w.lower() for w in toks)
                    named.update(w for i, w in enumerate(toks) if i and w[0].isupper() and w.isalpha())
        met.update(here)
    template = {w for lang, c in counts.items() for w, n in c.items() if n >= max(4, 0.012 * len(sentences[lang]))} | {",", ";", ":", "–", "—", "-"}
    vocabulary = {w for w, n in met.items() if n > 1}
    m = Model(np.zeros((DIMENSIONS, len(DEFECTS))), np.full(len(DEFECTS), 0.5), frozenset(vocabulary), frozenset(template), tongue)
    lower = Counter({w: n for c in counts.values() for w, n in c.items()})
    names = sorted(w for w, n in named.items() if lower[w.lower()] == 0)[:2_000]
    things = sorted(w for w in vocabulary if w.isalpha() and w.isascii() and len(w) > 4 and w not in template and lower[w] > 1)
    seeds = {lang: [x for x in SENTENCE.split(t) if x] for lang, t in SEEDS.items()}
    seed_clauses = {lang: [c.strip().rstrip(".?!。？！ ") for c in re.split(r"[,;，、،]|(?<=[.?!。？！])", t) if c.strip()] for lang, t in SEEDS.items()}
    made: list[tuple[list[str], list[str], str | None, tuple[int, ...]]] = []

    def add(prompt: list[str], answer: list[str], defect: str | None, mask: tuple[int, ...] = (1, 1, 1, 1, 1)) -> None:
        made.append((prompt, answer, defect, mask))

    def some(xs: list[str], most: int) -> list[str]:
        return rng.sample(xs, min(len(xs), rng.randrange(1, most + 1)))

    def clauses(lang: str) -> list[str]:
        """Ordinary talk in a language, put together anew from the clauses of its seed."""
        said = some(seed_clauses[lang], 3)
        return [", ".join(said).capitalize() + ("。" if lang in wording.SPACELESS else ".")] + some(seeds[lang], 2)[:-1]

    others = {lang: [q for l2, ps in by_language.items() if l2 not in (lang, "?") for q in ps] for lang in by_language}
    for p, lang in zip(prompts, langs):
        if not p:
            continue
        cut = rng.randrange(1, len(p)) if len(p) > 1 else 1
        prompt = p[:cut]
        answer = p[cut:] or rng.choice(by_language[lang])[-1:]
        add(prompt, answer, None)
        bare = answer[-1].rstrip(".?!。… ")
        if bare:
            add(prompt, [bare] if rng.random() < 0.5 else answer[:-1] + [bare], None)
        k = rng.randrange(4)
        add(prompt, [wording.stand_in(rng)] * (k + 1) if k < 2 else [rng.choice(wording.MARKS)] * rng.randrange(2) + [wording.stand_in(rng)], "empty", (1, 1, 1, 0, 0))
        add(prompt, [wording.short_reply(rng, names)], None, (1, 1, 1, 0, 0))
        own = [t for t in p if 0 < len(visible_words(t)) <= FEW_WORDS]
        if own:
            add(prompt, [rng.choice(own)], None, (1, 1, 0, 0, 1))
        for _ in range(2):
            t = _cut(rng, answer[-1])
            if t:
                add(prompt, answer[:-1] + [t], "truncated")
        c = min(len(prompt), rng.choice((1, 1, 1, 2, 3)))
        copy = [_reformatted(rng, t) if rng.random() < 0.7 / c else t for t in prompt[-c:]]
        add(prompt, copy, "copied", (1, 1, 1, 1, 0))
        if prompt[-1]:
            quote = " ".join(prompt[-1].split()[: rng.randrange(3, 8)])
            add(prompt, [rng.choice(REPLIES).format(q=quote) + answer[0]] + answer[1:], None)
        if lang != "?":
            if others[lang] and rng.random() < 0.6:
                q = rng.choice(others[lang])
            else:
                q = some(seeds[rng.choice([x for x in LANGUAGES if x != lang])], 5)
            add(prompt, q[-rng.randrange(1, 6) :], "other_language")
            mixed = [rng.choice(q) if rng.random() < 0.5 else t for t in answer + [rng.choice(p)]]
            theirs = sum(len(t) for t in mixed if t in q) / max(1, sum(map(len, mixed)))
            if abs(theirs - 0.5) > 0.03:
                add(prompt, mixed, "other_language" if theirs > 0.5 else None, (1, 1, 0, 1, 0))
            if len(q[-1]) < 200:
                add(prompt, answer + p + [rng.choice(p) + f" “{q[-1]}”"], None, (1, 1, 0, 1, 0))
        r = lang if lang in wording.REFUSAL_LANGUAGES and rng.random() < 0.4 else "en" if rng.random() < 0.3 else rng.choice(wording.REFUSAL_LANGUAGES)
        rest = answer if rng.random() < 0.15 else []
        for _ in range(3):
            add(prompt, [wording.refusal(rng, r), *rest], "refusal", (1, 1, 1, 0, 1))
        if rng.random() < 0.1:  # broken off
            said = wording.refusal(rng, r, 0.0).split(" ")
            if len(said) > 7:
                add(prompt, [" ".join(said[: rng.randrange(6, len(said))])], "refusal", (1, 1, 1, 0, 0))
        for _ in range(4):
            add(prompt, [wording.declined(rng, r, things, names)] + (answer if rng.random() < 0.5 else []), None, (1, 1, 1, 0, 1))
        for _ in range(2):
            add(prompt, [wording.in_passing(rng, r, sentences.get(r) or seeds[r], names)] + (answer if rng.random() < 0.5 else []), None, (1, 1, 1, 0, 1))
        for _ in range(5):
            add(prompt, clauses(rng.choice(LANGUAGES if rng.random() < 0.4 else wording.REFUSAL_LANGUAGES)), None, (1, 1, 1, 0, 0))
    # half of the beginnings lose some of their n-grams, as wordings do that were not learnt; so thresholds are calibrated for them, too
    low, high = OWN["refusal"]
    rows, shake = [], np.random.default_rng(seed)
    for k in range(0, len(made), 500):
        for idx, val in (f for f, _ in all_features([x[0] for x in made[k : k + 500]], [x[1] for x in made[k : k + 500]], m)):
            if shake.random() < 0.5:
                kept = (idx < low) | (idx >= high) | (shake.random(len(idx)) > LOST)
                idx, val = idx[kept], val[kept]
            rows.append((idx, val))
    labels = [[d == x[2] for d in DEFECTS] for x in made]
    masks = [x[3] for x in made]
    for lang, ss in sentences.items():  # endings alone, for the truncated label
        for s in rng.sample(ss, min(len(ss), 4_000 if lang == "en" else 2_500)):
            end = s.rstrip(".?!。… \"”)")
            for t, y in ((end, False), (_cut(rng, s), True), (_cut(rng, s), True), (_cut(rng, s), True)):
                if t and unended(t) is not None:
                    rows.append(_row([(_h("bias"), 1.0), (_h("few:False"), 2.0), *ending_features(unended(t), m)]))
                    labels.append([False] * 4 + [y])
                    masks.append((0, 0, 0, 0, 1))
    return rows, np.array(labels, float), np.array(masks, float), m


def _flat(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.zeros(len(rows), np.int64)
    np.cumsum([len(i) for i, _ in rows[:-1]], out=starts[1:])
    return np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts


def scores(rows: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> np.ndarray:
    """Probability of each defect."""
    idx, val, starts = _flat(rows)
    return 1 / (1 + np.exp(-np.clip(np.add.reduceat(weights[idx] * val[:, None], starts, axis=0), -30, 30)))


def _logistic(idx: np.ndarray, val: np.ndarray, owner: np.ndarray, y: np.ndarray, on: np.ndarray, steps: int, rate: float, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) of a logistic regression by Adagrad over all examples, those with ``on`` > 0."""
    kept = on[owner] > 0
    used, at = np.unique(idx[kept], return_inverse=True)
    row, owner = np.unique(owner[kept], return_inverse=True)
    v, y, on = val[kept], y[row], on[row]
    w, g2 = np.zeros(len(used)), np.full(len(used), 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, w[at] * v, len(row)), -30, 30)))
        g = np.bincount(at, ((p - y) * on)[owner] * v, len(used)) + decay * w
        g2 += g * g
        w -= rate * g / np.sqrt(g2)
    return used, w


def fit(prompts: list[list[str]], seed: int = 42, steps: int = 120, rate: float = 0.5, decay: float = 1e-5) -> Model:
    """Logistic regression of every defect, and the threshold of best F1 on every fifth example, held out. Prompts without words are left out."""
    prompts = [p for p in prompts if any(visible_words(t) for t in p)]
    if not prompts:
        prompts = [[x for x in SENTENCE.split(SEEDS["en"]) if x]]
    rows, y, mask, m = synthetic(prompts, seed)
    held = np.arange(len(rows)) % 5 == 4
    train = [r for r, h in zip(rows, held) if not h] or rows
    yt, mt = (y[~held], mask[~held]) if (~held).any() else (y, mask)
    idx, val, starts = _flat(train)
    owner = np.repeat(np.arange(len(train), dtype=np.int32), np.diff(np.append(starts, len(idx))))
    weights = np.zeros((DIMENSIONS, len(DEFECTS)))
    for d, defect in enumerate(DEFECTS):
        own = counts_for(defect, idx)
        most = MOST_WEIGHT.get(defect, 8.0)
        on = mt[:, d] * np.where(yt[:, d] > 0, min(most, max(1.0, (mt[:, d] * (1 - yt[:, d])).sum() / max(1, (mt[:, d] * yt[:, d]).sum()))), 1.0)
        used, w = _logistic(idx[own], val[own], owner[own], yt[:, d], on / max(on.sum(), 1), steps, rate, DECAY.get(defect, decay))
        weights[used, d] = w
    thresholds = np.full(len(DEFECTS), 0.5)
    if held.any():
        p = scores([r for r, h in zip(rows, held) if h], weights)
        for d in range(len(DEFECTS)):
            on = mask[held][:, d] > 0
            truth, q = y[held][on, d] > 0, p[on, d]
            grid = np.linspace(0.1, 0.9, 33)
            # clean answers count as often as they would if one in five were defective
            w = np.where(truth, 1.0, 4.0 * truth.sum() / max(1, (~truth).sum()))
            f1 = [2 * (w * (truth & (q >= t))).sum() / max(1e-9, w[truth].sum() + (w * (q >= t)).sum()) for t in grid]
            best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-9)
            thresholds[d] = grid[best[len(best) // 2]]
    return m._replace(weights=weights.astype(np.float32), thresholds=thresholds)


def save(spark: SparkSession, model: Model, path: str) -> None:
    """Keeps a fitted model in a folder, to score further rows with the same weights."""
    spark.createDataFrame([(bytearray(pickle.dumps(model)),)], "model binary").coalesce(1).write.parquet(path)


def load(spark: SparkSession, path: str) -> Model:
    """A model that ``save`` kept. The folder must be one's own: what is in it is unpickled."""
    return pickle.loads(bytes(spark.read.parquet(path).first()["model"]))


def judge(prompts: list[list[str]], answers: list[list[str]], m: Model) -> list[str | None]:
    """The defect of each answer, or None."""
    both = all_features(prompts, answers, m)
    if not both:
        return []
    p = scores([f for f, _ in both], m.weights)
    out: list[str | None] = []
    for (_, facts), q in zip(both, p):
        out.append(next((d for i, d in enumerate(DEFECTS) if q[i] >= m.thresholds[i] and confirmed(d, facts)), None))
    return out


def sample_prompts(pairs: DataFrame, rows: int = SAMPLE_ROWS) -> list[list[str]]:
    """Prompts of the ``rows`` rows of least hash: the only rows that come to the driver, for fitting."""
    keyed = pairs.filter(F.size("prompt") > 0).select("record_id", "prompt").orderBy(F.xxhash64(F.lit(7), "record_id"), "record_id").limit(rows)
    return [texts(r["prompt"]) for r in keyed.toLocalIterator()]


def defective(pairs: DataFrame, model: Model) -> DataFrame:
    """(record_id, field, defect) of ``pairs``(record_id, field, prompt array<string>, answer array<string>), each once."""
    ship(pairs.sparkSession)
    shared = pairs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for whole in batches:
            for k in range(0, len(whole), 1000):
                pdf = whole.iloc[k : k + 1000]
                found = judge([parts(x) for x in pdf["prompt"]], [parts(x) for x in pdf["answer"]], m)
                out = pdf[["record_id", "field"]].assign(defect=found)
                yield out[out["defect"].notna()]

    # one text for each side: far cheaper to hand over than arrays. No messages say as little as empty ones
    joined = lambda c: F.array_join(F.transform(c, lambda t: F.translate(F.coalesce(t, F.lit("")), BETWEEN, " ")), BETWEEN).alias(c)
    return pairs.select("record_id", "field", joined("prompt"), joined("answer")).mapInPandas(run, "record_id string, field string, defect string").distinct()
