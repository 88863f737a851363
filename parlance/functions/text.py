"""Text expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import let

WORD = r"[\p{L}\p{N}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def fold(c: Column) -> Column:
    """Case folding: lower case with 'ß' as 'ss', and one form of sigma and of s."""
    return F.replace(F.translate(F.lower(c), "ςſ", "σs"), F.lit("ß"), F.lit("ss"))


def words(c: Column) -> Column:
    """Maximal runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def bare(c: Column) -> Column:
    """The sequence of letters and digits, ignoring case."""
    return F.regexp_replace(fold(c), NOT_WORD, "")


def contents(messages: Column, sep: str = "\n") -> Column:
    """All message contents in order; null contents count as empty, null arrays as null."""
    return F.array_join(F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))), sep)


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


#: How a line may name its speaker.
SPEAKERS = (r"^Human [AB]:\s*", r"^Speaker [12]:\s*", r"^Person [AB]:\s*", r"^User:\s*", r"^Assistant:\s*", r"^[AB]:\s*", r"^SPK\d{2}-[A-Z]{3}\d{3}:\s*", r"^Target:\s*")


def fingerprint(c: Column) -> Column:
    """MD5 of the stripped text, in hexadecimal."""
    return F.md5(strip(c))


def lines(c: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda s: s != "")


def count_turns(c: Column) -> Column:
    """Number of lines that aren't blank, at least 1."""
    return F.greatest(F.size(lines(c)), F.lit(1))


def turn_bucket(turns: Column, buckets: tuple[tuple[int, int], ...]) -> Column:
    """The bucket that holds the number of turns, ends included; the last one for all others."""
    name = lambda b: F.lit(f"{b[0]}-{b[1]}")
    out = F.when(turns.between(*buckets[0]), name(buckets[0]))
    for b in buckets[1:-1]:
        out = out.when(turns.between(*b), name(b))
    return out.otherwise(name(buckets[-1]))


def without_speaker(line: Column) -> Column:
    """A line without the speakers' names at its front, taken off one kind after the other."""
    for pattern in SPEAKERS:
        line = F.regexp_replace(line, f"(?iU){pattern}", "")
    return line


def messages_of(content: Column) -> Column:
    """Messages of a dialogue text: its lines without speaker names, roles alternating from the user on."""
    said = F.filter(F.transform(lines(F.replace(content, F.lit("\\n"), F.lit("\n"))), without_speaker), lambda s: s != "")
    return F.transform(said, lambda s, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), s.alias("content")))


def context_lines(ctx: Column) -> Column:
    """Utterances of a context that are set apart by [UTT], with user1 and user2 as Speaker 1 and 2, a line each."""
    parts = F.filter(F.transform(F.split(ctx, r"\[UTT\]"), strip), lambda s: s != "")
    named = F.transform(parts, lambda s: F.replace(F.replace(s, F.lit("user1:"), F.lit("Speaker 1:")), F.lit("user2:"), F.lit("Speaker 2:")))
    return F.array_join(named, "\n")


def numbered_turns(conversation: Column) -> Column:
    """Lines 'SPK01-AAA001: …' as 'Turn n (Speaker k): …'; other lines go on with the turn before them, and are lost before the first."""
    own = r"(?U)^SPK\d{2}-[A-Z]{3}\d{3}:\s*"
    start = F.array().cast("array<string>")

    def add(turns: Column, line: Column) -> Column:
        begins = line.rlike(own)
        head = F.concat(F.lit("Turn "), (F.size(turns) + 1).cast("string"), F.when(line.startswith("SPK01"), " (Speaker 1): ").otherwise(" (Speaker 2): "), strip(F.regexp_replace(line, own, "")))
        longer = F.concat(F.slice(turns, F.lit(1), F.size(turns) - 1), F.array(F.concat(F.element_at(turns, -1), F.lit(" "), line)))
        return F.when(begins, F.concat(turns, F.array(head))).when(F.size(turns) > 0, longer).otherwise(turns)

    return F.array_join(F.aggregate(lines(conversation), start, add), "\n")


def spoken(messages: Column) -> Column:
    """'User: …' and 'Assistant: …', a line each."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.when(F.lower(m["role"]) == "user", "User: ").otherwise("Assistant: "), F.coalesce(m["content"], F.lit("")))), "\n")


def strip_code_fences(c: Column) -> Column:
    """The text from the first brace to the last, code fences taken off; null gives an empty text."""
    fenced = lambda s: F.when(s.startswith("```"), strip(F.regexp_replace(strip(F.regexp_replace(s, r"(?i)^```(?:json)?\s*", "")), r"\s*```$", ""))).otherwise(s)
    braced = lambda s: F.coalesce(F.nullif(F.regexp_extract(s, r"(?s)\{.*\}", 0), F.lit("")), s)
    return let(let(strip(F.coalesce(c, F.lit(""))), fenced), braced)


def fix_json(c: Column) -> Column:
    """One kind of line end, and no commas before a closing bracket."""
    return F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), r",\s*([}\]])", "$1")
