"""Problem 9: visually identical text in different characters, by confusables skeletons.

``Looks.skeleton`` decomposes a text, replaces every character by the prototype of its look-alike class, and decomposes again.
Texts of equal skeleton look the same. The prototypes are those of the public Unicode confusables, read from the ICU library
that Spark ships, and a few more. ``Looks.one_form`` gives the readable text that all of them share: composed, half-width
ASCII, ordinary spaces and letters, nothing invisible; and a letter of another alphabet inside a word is put back into the
word's own alphabet where that leaves the word's skeleton as it is. The kinds name why a text was not in that form.

A text and its form have one skeleton. The reverse doesn't hold: letters of one alphabet that look alike (l, I and 1), words
that stand wholly in another alphabet, and phonetic letters keep forms of their own.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.session import ship

#: What kept a text from its form. TESTDATA's problem lists the first five; ``styled`` are letters drawn in another style,
#: ligatures, and characters that only stand for another.
KINDS = ("wide", "combining", "space", "invisible", "lookalike", "styled")
LISTED = KINDS[:5]

#: Letters of other alphabets and the Latin letter that they are read as, where the prototypes give none or two.
LOOKALIKES = {
    "CYRILLIC": dict(zip("аАВсСԁеЕһНіІјЈкКӏмМоОрРԛѕЅтТѵԝхХуУԌԜԚѴҺӀүҮгьЬѡ", "aABcCdeEhHiIjJkKlmMoOpPqsStTvwxXyYGWQVhlyYrbbw")),
    "GREEK": dict(zip("αΑΒΕΗιΙκΚΜνΝοΟρΡτΤυΥχΧγΖϲϳωσηϹͿϱϜϺ", "aABEHiIkKMvNoOpPtTuYxXyZcjwonCJpFM")),
    "ARMENIAN": dict(zip("օՕսՍհոցգզյլԼաքՏռ", "oOuUhngqqjlLwfSn")),
}
PROTOTYPE = {c: p for table in LOOKALIKES.values() for c, p in table.items()}


def _class(*ranges: tuple[int, int]) -> str:
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


#: Code points that show nothing (the joiner 200D is apart), space characters, and where emoji stand.
INVISIBLE = ((0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180E), (0x200B, 0x200C), (0x200E, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xE0001, 0xE0001))
SPACES = ((0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
EMOJI = ((0xA9, 0xA9), (0xAE, 0xAE), (0x203C, 0x203C), (0x2049, 0x2049), (0x2122, 0x2122), (0x2139, 0x2139), (0x2194, 0x21AA), (0x2300, 0x23FF), (0x24C2, 0x24C2), (0x25AA, 0x27BF), (0x2934, 0x2935), (0x2B05, 0x2B55), (0x3030, 0x303D), (0x3297, 0x3299), (0x1F000, 0x1FAFF))
WIDE = ((0xFF01, 0xFF5E), (0xFF61, 0xFF9F))
#: Where letters of other alphabets than Latin stand that have cases or are taken for such letters; not Chinese, Japanese, Korean.
ODD = ((0x370, 0x1DFF), (0x1F00, 0x1FFF), (0x2C80, 0x2DFF), (0xA4D0, 0xA7FF), (0xAB30, 0xABFF), (0xFB13, 0xFB4F), (0x10280, 0x1D3FF), (0x1E000, 0x1EFFF))
LATIN = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF))
#: Alphabets that a word may be put back into, and where their letters are.
HOMES = {"LATIN": ((0x41, 0x5A), (0x61, 0x7A)), "GREEK": ((0x391, 0x3C9),), "CYRILLIC": ((0x410, 0x44F), (0x400, 0x40F), (0x450, 0x45F)), "ARMENIAN": ((0x531, 0x587),)}
_NOT_MARKS = {0x200D, 0x34F, 0x17B4, 0x17B5, 0x20E3, *range(0xFE00, 0xFE10), *range(0x180B, 0x1810)}


#: All combining marks but the emoji's variation selectors, from the character database.
MARK_CHARS = frozenset(chr(c) for c in (*range(0x300, 0x20000), *range(0xE0000, 0xE0200)) if c not in _NOT_MARKS and unicodedata.category(chr(c))[0] == "M")
#: Letters in a style of their own (mathematical bold and the like), Latin and Armenian ligatures, and characters that are
#: composed into another one when they stand alone, from the character database.
STYLED_CHARS = frozenset(
    c
    for c in map(chr, (*range(0x2000, 0x3000), *range(0xF900, 0xFB50), *range(0x1D400, 0x1D800), *range(0x1EE00, 0x1EF00), *range(0x1FBF0, 0x1FBFA), *range(0x2F800, 0x2FA20)))
    if not unicodedata.category(c)[0] in "MZ" and (unicodedata.decomposition(c).startswith("<font>") or "\ufb00" <= c <= "\ufb17" or unicodedata.normalize("NFC", c) != c)
)


_JOINER = "\u200d"
_EMOJI = re.compile(f"[{_class(*EMOJI)}]")
_of = lambda *ranges: frozenset(chr(c) for a, b in ranges for c in range(a, b + 1))
#: Sets of characters, to be held against those of a text.
INVISIBLE_CHARS, SPACE_CHARS, WIDE_CHARS, ODD_CHARS = _of(*INVISIBLE, (0x200D, 0x200D)), _of(*SPACES), _of(*WIDE), _of(*ODD)
_BEFORE_JOINER = re.compile(f"[{_class(*EMOJI, (0xFE0F, 0xFE0F))}]")
_INVISIBLE = re.compile(f"[{_class(*INVISIBLE)}]+")
_SPACE = re.compile(f"[{_class(*SPACES)}]")
_WIDE = re.compile(f"[{_class(*WIDE)}]+")
_MARK_CLASS = "".join(map(re.escape, sorted(MARK_CHARS)))
_WORD = re.compile(rf"[^\W\d_](?:[^\W\d_]|[{_MARK_CLASS}])*")
_ODD_CLASS, _LATIN_CLASS = f"[{_class(*ODD)}]", f"[{_class(*LATIN)}]"
#: A letter of one alphabet next to one of another.
_MIXED = re.compile("|".join([_LATIN_CLASS + _ODD_CLASS, _ODD_CLASS + _LATIN_CLASS] + [x for n, r in HOMES.items() if n != "LATIN" for x in (f"[{_class(*r)}](?![{_class(*r)}]){_ODD_CLASS}", f"(?![{_class(*r)}]){_ODD_CLASS}[{_class(*r)}]")]))


def _joined(text: str) -> str:
    """Without the joiners that don't stand between two emoji."""
    if _JOINER not in text:
        return text
    parts = text.split(_JOINER)
    out = [parts[0]]
    for left, right in zip(parts, parts[1:]):
        keep = left and right and _BEFORE_JOINER.match(left[-1]) and _EMOJI.match(right[0])
        out += [_JOINER if keep else "", right]
    return "".join(out)


@lru_cache(4096)
def _alphabet(ch: str) -> str | None:
    """The alphabet of a letter; None for marks and superscript digits."""
    o = ord(ch)
    if not ch.isalpha():
        return None
    if o < 0x250 or 0x1E00 <= o <= 0x1EFF:
        return "LATIN"
    return unicodedata.name(ch, "?").split(" ")[0].split("-")[0]


class Looks:
    """Forms and skeletons by a table of prototypes: {character: what it is drawn as}, of characters that aren't their own prototype."""

    def __init__(self, prototypes: dict[str, str]):
        self.prototypes = prototypes
        own = lambda c: prototypes.get(c, c)
        table = prototypes | {c: own(p) for c, p in PROTOTYPE.items()}
        self._table = str.maketrans(table)
        # per alphabet, the letter of each prototype and case
        self._homes: dict[str, dict[tuple[str, bool], str]] = {}
        for name, ranges in HOMES.items():
            letters = self._homes[name] = {}
            for c in (chr(o) for a, b in ranges for o in range(a, b + 1)):
                if c.isalpha() and unicodedata.normalize("NFD", c) == c:
                    letters.setdefault((table.get(c, c), c.isupper()), c)

    def __reduce__(self):
        return Looks, (self.prototypes,)

    def _drawn(self, t: str) -> str:
        """Decompose, replace every character by its prototype, decompose again."""
        return unicodedata.normalize("NFD", unicodedata.normalize("NFD", t).translate(self._table))

    def _letter(self, c: str, home: str) -> str | None:
        """The letter of an alphabet that looks as ``c`` does, with its marks; None if there is none."""
        base, *marks = unicodedata.normalize("NFD", c)
        if home == "LATIN" and base in PROTOTYPE:
            found = PROTOTYPE[base]
        else:
            found = self._homes[home].get((self._table.get(ord(base), base), base.isupper()))
        return found and unicodedata.normalize("NFC", found + "".join(marks))

    def unmixed(self, word: str) -> str:
        """The word in one alphabet, if all its letters of other alphabets look like letters of that one; else the word."""
        if word.isascii():
            return word
        own = list(map(_alphabet, word))
        there = set(own) - {None}
        if len(there) < 2:
            return word
        for home in sorted(there & self._homes.keys(), key=lambda a: (-own.count(a), a)):
            out = [c if a in (home, None) else self._letter(c, home) for c, a in zip(word, own)]
            if None not in out:
                clean = "".join(out)
                if self._drawn(clean) == self._drawn(word):
                    return clean
        return word

    def _stages(self, text: str) -> tuple[str, list[str]]:
        """The text without what isn't seen and in plain characters, and the kinds of what was replaced: the first half of skeleton and form alike."""
        kinds, chars = [], set(text)
        if not MARK_CHARS.isdisjoint(chars):
            kinds.append("combining")
        t = text
        if not WIDE_CHARS.isdisjoint(chars):
            kinds.append("wide")
            t = _WIDE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), t)
        if not INVISIBLE_CHARS.isdisjoint(chars):
            u = _joined(_INVISIBLE.sub("", t))
            if u != t:
                kinds.append("invisible")
                t = u
        if not SPACE_CHARS.isdisjoint(chars):
            kinds.append("space")
            t = _SPACE.sub(" ", t)
        if not STYLED_CHARS.isdisjoint(chars):
            kinds.append("styled")
            t = "".join(unicodedata.normalize("NFKC", c) if c in STYLED_CHARS else c for c in t)
        return unicodedata.normalize("NFC", t), kinds

    def one_form(self, text: str) -> tuple[str, list[str]]:
        """The text in its one form, and the kinds of characters that kept it from it.

        A letter of another alphabet is found by skeletons: it is one if the word has the skeleton of a word of one alphabet.
        """
        if text.isascii():
            return text, []
        t, kinds = self._stages(text)
        if not ODD_CHARS.isdisjoint(t) and (not MARK_CHARS.isdisjoint(t) or _MIXED.search(t)):
            u = _WORD.sub(lambda m: self.unmixed(m[0]), t)
            if u != t:
                kinds.append("lookalike")
                t = unicodedata.normalize("NFC", u)  # a letter put back may compose with its mark
        return t, sorted(kinds, key=KINDS.index)

    def skeleton(self, text: str) -> str:
        """What the text is drawn as; of plain ASCII, too, since some of its letters look alike."""
        return self._drawn(text if text.isascii() else self._stages(text)[0])


_LOOKS: dict[str, Looks] = {}


def looks(spark: SparkSession) -> Looks:
    """By the prototypes of the ICU library of Spark's JVM: one call for all characters but Chinese and Korean ones; some 6,000 entries, whatever the data."""
    app = spark.sparkContext.applicationId
    if app not in _LOOKS:
        checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        chars = [chr(o) for o in (*range(0x21, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x18000), *range(0x1D000, 0x20000)) if unicodedata.category(chr(o))[0] in "LNPS"]
        drawn = checker.getSkeleton("\n".join(chars)).split("\n")
        _LOOKS[app] = Looks({c: p for c, p in zip(chars, drawn, strict=True) if p != unicodedata.normalize("NFD", c) and len(c) == 1})
    return _LOOKS[app]


#: The same classes for the JVM: a text that matches nowhere is in its one form.
_JAVA = lambda *rs: "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in rs)


#: Where the styled characters stand, with others between them.
_STYLED = ((0x2100, 0x214F), (0x2329, 0x232A), (0x2ADC, 0x2ADC), (0xF900, 0xFB4F), (0x1D400, 0x1D7FF), (0x1EE00, 0x1EEFF), (0x1FBF0, 0x1FBF9), (0x2F800, 0x2FA1F))
#: Each class is cut with a range first, so that an ASCII character costs one comparison.
MARKED = f"[[^\\x00-\\x9f]&&[{_JAVA(*WIDE, *SPACES, *INVISIBLE, (0x200D, 0x200D), *_STYLED)}\\p{{M}}]]"
_ODD_ONE = f"[^\\x00-\\x{{36f}}]&&[{_JAVA(*ODD)}]"
ODD_LETTER = f"[{_ODD_ONE}]"


def _beside(own: str, other: str) -> str:
    """One of ``own`` before or after one of ``other``."""
    return f"[{own}](?=[{other}])|[{own}](?<=[{other}][{own}])"


#: Looked for at the odd letter, of which texts have few.
MIXED = f"(?={ODD_LETTER})(?:" + "|".join([_beside(_ODD_ONE, _JAVA(*LATIN))] + [_beside(_JAVA(*r), f"{_ODD_ONE}&&[^{_JAVA(*r)}]") for n, r in HOMES.items() if n != "LATIN"]) + ")"


def _forms_udf(spark: SparkSession):
    shared = spark.sparkContext.broadcast(looks(spark))

    def forms(texts: pd.Series) -> pd.DataFrame:
        form = shared.value.one_form
        found = [(None, []) if t is None else form(t) for t in texts]
        return pd.DataFrame({"clean": [f[0] for f in found], "kinds": [f[1] for f in found]})

    return F.pandas_udf(forms, "clean string, kinds array<string>")


def _skeletons_udf(spark: SparkSession):
    shared = spark.sparkContext.broadcast(looks(spark))

    def skeletons(texts: pd.Series) -> pd.Series:
        skeleton = shared.value.skeleton
        return pd.Series([None if t is None else hashlib.md5(skeleton(t).encode("utf-8", "surrogatepass")).hexdigest() for t in texts], dtype=object)

    return F.pandas_udf(skeletons, "string")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def not_ascii(t: Column) -> Column:
    return F.octet_length(t) != F.length(t)


def _suspect() -> Column:
    t = F.col("text")
    return not_ascii(t) & (t.rlike(MARKED) | (t.rlike(ODD_LETTER) & t.rlike(MIXED)))


def normalized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, clean, kinds) of every row: each text in its one form, and what kept it from it.

    Texts with none of the characters in question are in form and go to Python as nulls only; the others in Arrow batches. Null texts keep a null form and no kinds; empty texts are in form. Other columns are not looked at; repeated
    rows come out repeated.
    """
    rows = _rows(docs, id_col, text_col).withColumn("form", _forms_udf(docs.sparkSession)(F.when(_suspect(), F.col("text"))))
    return rows.select("doc_id", F.coalesce("form.clean", "text").alias("clean"), F.col("form.kinds").alias("kinds"))


def kinds_found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kind): the documents that are not in the one form, with a row for each of the listed kinds present."""
    found = _rows(docs, id_col, text_col).filter(_suspect()).select("doc_id", _forms_udf(docs.sparkSession)("text").alias("s"))
    return found.select("doc_id", F.explode("s.kinds").alias("kind")).filter(F.col("kind").isin(*LISTED))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(skeleton_hash, n_docs, n_unformed, first_id): originals grouped by equal skeleton, counted with map-side combining.

    A skeleton shared by any share of all rows needs no more than one row of each task in the shuffle. Null texts form no
    group; all empty texts form one.
    """
    rows = _rows(docs, id_col, text_col).filter("text is not null")
    keyed = rows.select("doc_id", _skeletons_udf(docs.sparkSession)("text").alias("skeleton_hash"), _forms_udf(docs.sparkSession)(F.when(_suspect(), F.col("text")))["kinds"].alias("kinds"))
    return keyed.groupBy("skeleton_hash").agg(F.count("*").alias("n_docs"), F.count_if(F.size("kinds") > 0).alias("n_unformed"), F.min("doc_id").alias("first_id"))
