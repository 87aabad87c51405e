"""Secret scans (operator 12): DataFrame functions only.

Two kinds of spans are found in every text.

*Base spans* are matches of fixed patterns (``assign``, ``access``, ``hex``): leftmost,
non-overlapping within a kind, those with a value shorter than the kind's minimum dropped.

*Entropy spans* come from candidate strings, the maximal runs of a character class.  A
window slides over each run with the counts of its characters kept up to date: one
character leaves, one enters, and the sum of c log c over the counts changes by two table
entries.  The counts are five bits each, twelve to a 64-bit integer, and the sum is in
whole 2^-20ths, so it is exact and the same in every order.  Windows with an entropy of
the class's limit or more are united where they overlap or touch.  What a pattern of the
allow-list matches in a run (placeholders, UUIDs, words joined by signs, alphabets, labelled
digests) is cut out first; the window slides over what is left on either side.  The
allow-list never touches base spans.

Positions without Python: ``split`` gives the text between the matches and
``regexp_extract_all`` the matches; the places are running sums of both lengths, in blocks.
Runs are worked on in chunks of ``CHUNK`` windows, whose spans are joined afterwards, so the
cost is linear in a run's length.  It is one map stage; a text that no pattern meets pays for the
pattern tests alone.

Defined results: spans are code points, end exclusive, over the whole text; a null text is
empty and has none; sorted by start, then kind in the order given, then end; repeated or null ids
are rows like others; further columns are kept out.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Windows of one chunk of a run; matches whose lengths are summed in one block.
CHUNK = 2048
BLOCK = 256
#: Five bits a count, twelve counts a 64-bit integer.
BITS, PACKED = 5, 12
UNIT = 1 << 20


@dataclass(frozen=True)
class Pattern:
    """A base kind: matches whose ``group`` has ``least`` code points or more."""

    kind: str
    regex: str
    group: int
    least: int


@dataclass(frozen=True)
class CharacterClass:
    """A kind of entropy span: runs of these (ASCII) characters, a window of at most 31, and its least entropy in bits a character."""

    kind: str
    characters: str
    window: int
    bits: float

    @property
    def regex(self) -> str:
        return "[" + "".join("\\" + c if c in "-\\]^[" else c for c in self.characters) + "]{" + str(self.window) + ",}"

    @property
    def most(self) -> int:
        """The largest sum of c log c (in units) that a window may have."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * UNIT)


UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"

# The patterns of the base kinds, as the contract states them.
PATTERNS = (
    Pattern("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Pattern("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    Pattern("hex", r"([0-9a-f]+)", 1, 16),
)
CLASSES = (
    CharacterClass("entropy_hex", DIGITS + "abcdefABCDEF", 20, 3.0),
    CharacterClass("entropy_upper", UPPER + DIGITS, 16, 3.4),
    CharacterClass("entropy_base64", UPPER + LOWER + DIGITS + "+/_-", 24, 4.0),
)
#: What is cut out of the runs before the window slides: a pattern takes as much of a run as it matches.
ALLOWED = (
    r"^.*(?i:example|placeholder|changeme|dummy|redacted).*$",
    r"^.*(?i:abcdefghij|0123456789|9876543210|qwertyuiop).*$",
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
    r"^(?:[A-Z]?[a-z]+|[A-Z]+)(?:[+/_-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[+/_-]*$",
    r"^sha(?:1|256|384|512)-.*$",
)


def steps(most: int = 31) -> list[int]:
    """What the sum of c log c grows by, in units, when a count reaches c; 0 at c = 0."""
    whole = [round(c * math.log2(c) * UNIT) if c else 0 for c in range(most + 1)]
    return [0] + [b - a for a, b in zip(whole, whole[1:])]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def _running(lengths: Column) -> Column:
    """For every element, the sum of those before it; in blocks, so that long arrays stay cheap."""
    def blocks(x: Column) -> Column:
        number = F.ceil(F.size(x) / F.lit(BLOCK)).cast("int")
        sums = F.transform(F.sequence(F.lit(0), number - 1), lambda b: _sum(F.slice(x, b * BLOCK + 1, F.lit(BLOCK))))
        return _let(sums, lambda s: _let(F.transform(s, lambda _, b: _sum(F.slice(s, F.lit(1), b))), lambda base: F.transform(
            x, lambda _, i: F.get(base, F.floor(i / F.lit(BLOCK)).cast("int")) + _sum(F.slice(x, i - i % BLOCK + 1, i % BLOCK)))))
    return _let(lengths, blocks)


def _nothing(kind: str) -> Column:
    return F.array().cast(kind)


def _cut(text: Column, regex: str, group: int) -> Column:
    """What lies before, between and after the matches (start, gap), with the match that follows (value, end; null at last)."""
    def place(found: Column) -> Column:
        both = F.zip_with(found["gaps"], F.arrays_zip(found["all"], found["values"]), lambda g, m: F.struct(
            g.alias("gap"), m["values"].alias("value"), F.char_length(g).cast("bigint").alias("before"), F.char_length(m["all"]).alias("length")))
        return _let(both, lambda x: _let(_running(F.transform(x, lambda e: e["before"] + F.coalesce(e["length"], F.lit(0)))), lambda starts: F.zip_with(
            x, starts, lambda e, start: F.struct(start.alias("start"), e["gap"].alias("gap"), (start + e["before"]).alias("at"),
                                                 (start + e["before"] + e["length"]).alias("end"), e["value"].alias("value")))))

    return _let(F.struct(F.split(text, regex, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("all"),
                         F.regexp_extract_all(text, F.lit(regex), F.lit(group)).alias("values")), place)


def _matches(text: Column, regex: str, group: int) -> Column:
    """(start, end, value) of every match, as the regex finds them from left to right."""
    found = F.transform(F.filter(_cut(text, regex, group), lambda x: x["end"].isNotNull()),
                        lambda x: F.struct(x["at"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))
    return F.when(text.rlike(regex), found).otherwise(_nothing("array<struct<start:bigint,end:bigint,value:string>>"))


def _parts(run: Column, allowed: tuple[str, ...], least: int) -> Column:
    """(start, value) of a run's parts outside allow-listed matches, those of ``least`` characters and more."""
    whole = F.array(F.struct(run["start"].alias("start"), run["value"].alias("value")))
    if not allowed:
        return whole
    regex = any_of(allowed)
    parts = F.transform(F.filter(_cut(run["value"], regex, 0), lambda x: F.char_length(x["gap"]) >= least),
                        lambda x: F.struct((run["start"] + x["start"]).alias("start"), x["gap"].alias("value")))
    return F.when(run["value"].rlike(regex), parts).otherwise(whole)


def any_of(patterns: tuple[str, ...]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def _base(text: Column, pattern: Pattern) -> Column:
    # A run of the class that is too short is a failing match that takes nothing from later ones,
    # so its length can be part of the regex; a short value of an assignment does take its text.
    regex = pattern.regex[:-2] + "{%d,})" % (pattern.least - (4 if pattern.kind == "access" else 0)) if pattern.kind in ("access", "hex") else pattern.regex
    found = _matches(text, regex, pattern.group)
    return F.transform(F.filter(found, lambda m: F.char_length(m["value"]) >= pattern.least), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))


_SPANS = "array<struct<start:bigint,end:bigint>>"


def _slide(codes: Column, first: Column, chars: CharacterClass) -> Column:
    """Spans of united windows that begin in the chunk at ``first``; places count from the run's start."""
    w, table = chars.window, F.lit(steps())
    longs = -(-len(chars.characters) // PACKED)
    last = F.least(first + CHUNK + w - 1, F.size(codes))  # one past the chunk's last character

    def count(words: Column, code: Column) -> Column:
        return F.call_function("shiftright", F.get(words, _word(code)), _shift(code)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def step(state: Column, at: Column) -> Column:
        entering = F.get(codes, at)
        leaving = F.when(at - first >= w, F.get(codes, at - w)).otherwise(F.lit(-1))
        return _let(F.struct(state.alias("s"), at.alias("at"), entering.alias("i"), leaving.alias("o")), moved)

    def moved(x: Column) -> Column:
        s, i, o = x["s"], x["i"], x["o"]
        out = F.when(o >= 0, F.get(table, count(s["words"], o))).otherwise(F.lit(0))
        held = count(s["words"], i) - F.when(i == o, F.lit(1)).otherwise(F.lit(0))
        words = F.transform(s["words"], lambda word, j: word + F.when(_word(i) == j, _unit(i)).otherwise(F.lit(0).cast("bigint"))
                            - F.when((o >= 0) & (_word(o) == j), _unit(o)).otherwise(F.lit(0).cast("bigint")))
        total = s["total"] - out + F.get(table, held + 1)
        return _let(F.struct(words.alias("words"), total.cast("bigint").alias("total"), s["open"].alias("open"), s["until"].alias("until"), s["spans"].alias("spans"),
                             (x["at"] - (w - 1)).cast("bigint").alias("q")), lambda y: judged(y, first))

    def judged(y: Column, begin: Column) -> Column:
        hit = (y["q"] >= begin) & (y["total"] <= F.lit(chars.most))
        joins = hit & (y["until"] >= y["q"])
        opens = hit & (y["until"] < y["q"])
        closed = F.when(opens & (y["until"] >= 0), F.concat(y["spans"], F.array(F.struct(y["open"].alias("start"), y["until"].alias("end"))))).otherwise(y["spans"])
        return F.struct(y["words"].alias("words"), y["total"].alias("total"), F.when(opens, y["q"]).otherwise(y["open"]).alias("open"),
                        F.when(joins | opens, y["q"] + w).otherwise(y["until"]).alias("until"), closed.alias("spans"))

    start = F.struct(F.array_repeat(F.lit(0).cast("bigint"), longs).alias("words"), F.lit(0).cast("bigint").alias("total"),
                     F.lit(-1).cast("bigint").alias("open"), F.lit(-1).cast("bigint").alias("until"), _nothing(_SPANS).alias("spans"))
    return F.aggregate(F.sequence(first, last - 1), start, step, lambda s: F.when(
        s["until"] >= 0, F.concat(s["spans"], F.array(F.struct(s["open"].alias("start"), s["until"].alias("end"))))).otherwise(s["spans"]))


def _word(code: Column) -> Column:
    return F.floor(code / F.lit(PACKED)).cast("int")


def _shift(code: Column) -> Column:
    return (code % F.lit(PACKED)) * F.lit(BITS)


def _unit(code: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), _shift(code))


def _united(spans: Column) -> Column:
    """Sorted spans of which only neighbours overlap or touch, joined."""
    def join(s: Column) -> Column:
        heads = F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["end"] < x["start"]))
        tails = F.filter(s, lambda x, i: (i == F.size(s) - 1) | (F.get(s, i + 1)["start"] > x["end"]))
        return F.zip_with(heads, tails, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))
    return _let(spans, join)


def _entropy(text: Column, chars: CharacterClass, allowed: tuple[str, ...]) -> Column:
    """Spans of high entropy in the class's runs, outside what the allow-list matches."""
    def spans_of(part: Column) -> Column:
        letters = F.transform(F.split(part["value"], ""), lambda c: F.instr(F.lit(chars.characters), c) - 1)
        chunks = _let(letters, lambda codes: F.flatten(F.transform(
            F.sequence(F.lit(0), F.size(codes) - chars.window, F.lit(CHUNK)), lambda first: _slide(codes, first, chars))))
        return F.transform(_united(chunks), lambda s: F.struct((part["start"] + s["start"]).alias("start"), (part["start"] + s["end"]).alias("end")))

    runs = F.flatten(F.transform(_matches(text, "(" + chars.regex + ")", 1), lambda run: _parts(run, allowed, chars.window)))
    return F.flatten(F.transform(runs, spans_of))


def scan(docs: DataFrame, patterns: tuple[Pattern, ...] = PATTERNS, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, found): every row's spans as an array of (start, rank of the kind, end, kind), sorted."""
    text = F.coalesce(docs[text_column], F.lit(""))
    kinds = [(p.kind, _base(text, p)) for p in patterns] + [(c.kind, _entropy(text, c, allowed)) for c in classes]
    return docs.select(docs[id_column], F.sort_array(F.concat(*(_tagged(spans, rank, kind) for rank, (kind, spans) in enumerate(kinds)))).alias("found"))


def _tagged(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _said(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _ranked(rank: int) -> Column:
    return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("bigint")


def digest(found: DataFrame, patterns: tuple[Pattern, ...] = PATTERNS, id_column: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""
    base = F.filter("found", lambda s: s["rank"] < len(patterns))
    return found.select(id_column, *(_ranked(rank).alias(f"n_{p.kind}") for rank, p in enumerate(patterns)),
                        F.sha2(_said(base), 256).alias("base_sha256"), _said(F.col("found")).alias("spans"))
