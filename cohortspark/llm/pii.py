"""Personal data: patterns propose spans, validators confirm them, nearby words adjust the score.

Every step is an expression on the text's own row, so nothing is shuffled. Positions are code points.
The patterns say what the plain ones in their comments say; possessive parts and checks of the place
before a match only keep long runs from being scanned again and again, or from deep recursion.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Matches are placed in blocks of so many, so that no long array is copied for each of them.
BLOCK = 64
#: Characters before and after a match that are searched for context words, whatever other matches lie there.
CONTEXT_CHARS = 48
#: Spans below this score are dropped.
LEAST_SCORE = 0.5


@dataclass(frozen=True)
class Kind:
    """``score`` is what a confirmed match has by itself; a context word adds ``bonus``."""

    name: str
    pattern: str
    hint: str
    score: float
    context: str
    bonus: float = 0.3


# Countries by the length of their account numbers.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG YE", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Numbers of the length that their country has, so that a word after them is not taken; of any length where the country is not listed."""
    listed = "|".join(c for cs in IBAN_COUNTRIES.values() for c in cs.split())
    sized = [rf"(?:{'|'.join(cs.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
             for n, cs in IBAN_COUNTRIES.items()]
    sized.append(rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?")
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(sized)})(?![A-Za-z0-9])"


_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?>(?:\.[A-Za-z0-9-]++){1,200})+",
         "@", 0.7, r"mail|contact|write|schreib|courriel|correo"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, r"\b(?:ip|host|server|address|adresse)\b"),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?>(?:[\x20-]?[0-9]){1,200})+", "", 0.7, r"card|visa|karte|carte|tarjeta|kredit"),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, r"phone|call|tel|fon|appel|llam"),
    Kind("iban", _iban(), "", 0.7, r"iban|account|konto|compte|cuenta"),
    Kind("amex", r"(?<![0-9-])3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![0-9-])", "3", 0.4, r"card|amex|karte|carte|tarjeta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, r"ssn|social|security"),
)
BASE = ("email", "ip", "card", "phone")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without blanks leaves 1 when divided by 97, its first four characters moved to the end."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    characters = F.filter(F.split(moved, ""), lambda c: c != "")
    return F.aggregate(characters, F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    """The kind's validator."""
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = _digits(match)
    if kind == "card":  # most matches are short numbers
        return F.when(F.length(match) < 16, False).when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "amex":
        return luhn(digits)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~match.rlike(r"^(?:000|666|9[0-9]{2})|-00-|-0000$")
    return F.lit(True)


def proposed(text: Column, kind: Kind) -> Column:
    """Matches of a kind with the text before each: array of (gap, match)."""
    pattern = F.lit(kind.pattern)
    pairs = F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
    none = F.array().cast("array<struct<gap:string,match:string>>")
    has = text.contains(kind.hint) if kind.hint else text.rlike("[0-9]")
    return F.when(has, F.transform(pairs, lambda x: F.struct(x["gap"].alias("gap"), x["match"].alias("match")))).otherwise(none)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scored(pairs: Column, kind: Kind) -> Column:
    """Each match with the length of the gap before it, and its score (0 where the validator fails)."""
    #: A gap and a match have three characters at least, so this many reach over the context.
    around = CONTEXT_CHARS // 3

    def near(all_: Column, i: Column) -> Column:
        """Whether a context word lies within reach on either side; a word may lie across the matches between."""
        since = F.greatest(i - around, F.lit(0))
        before = F.transform(F.slice(all_, since + 1, i - since), lambda x: F.concat(F.right(x["gap"], F.lit(CONTEXT_CHARS)), x["match"]))
        before = F.concat(F.array_join(before, ""), F.right(F.get(all_, i)["gap"], F.lit(CONTEXT_CHARS)))
        after = F.transform(F.slice(all_, i + 2, F.lit(around)), lambda x: F.concat(F.left(x["gap"], F.lit(CONTEXT_CHARS)), F.coalesce(x["match"], F.lit(""))))
        sides = (F.right(before, F.lit(CONTEXT_CHARS)), F.left(F.array_join(after, ""), F.lit(CONTEXT_CHARS)))
        return F.lower(sides[0]).rlike(kind.context) | F.lower(sides[1]).rlike(kind.context)

    def one(all_: Column) -> Callable[[Column, Column], Column]:
        def score(x: Column, i: Column) -> Column:
            bonus = F.when(near(all_, i), kind.bonus).otherwise(0.0)
            return F.struct(F.char_length(x["gap"]).alias("gap"), F.char_length(x["match"]).alias("length"),
                            F.when(confirmed(kind.name, x["match"]), F.lit(kind.score) + bonus).otherwise(F.lit(0.0)).alias("score"))

        return score

    return _bound(pairs, lambda all_: F.transform(F.filter(all_, lambda x: x["match"].isNotNull()), one(all_)))


SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"


def placed(found: Column, kind: Kind) -> Column:
    """Spans of the matches with the least score or more: one walk over all matches that carries the position."""
    none = F.array().cast(f"array<{SPAN}>")

    def span(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        return F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + x["length"]).alias("end"), x["score"].alias("score")).cast(SPAN)

    def step(acc: Column, x: Column) -> Column:
        more = F.when(x["score"] >= LEAST_SCORE, F.concat(acc["out"], F.array(span(acc["at"], x)))).otherwise(acc["out"])
        return F.struct((acc["at"] + x["gap"] + x["length"]).alias("at"), more.alias("out"))

    def block(acc: Column, items: Column) -> Column:
        walked = F.aggregate(items, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return _bound(walked, lambda w: F.struct(w["at"].alias("at"), F.when(F.size(w["out"]) > 0, F.concat(acc["out"], F.array(w["out"]))).otherwise(acc["out"]).alias("out")))

    def walk(all_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(all_), F.lit(BLOCK)), lambda b: F.slice(all_, b + 1, F.lit(BLOCK)))
        begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out"))
        return F.aggregate(blocks, begin, block, lambda acc: F.flatten(acc["out"]))

    return _bound(found, walk)


def find_pii(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with ``pii``: array of (kind, start, end, score) by kind as listed, then start.

    A null or empty text has none. Confirmed emails, addresses, cards and phone numbers always pass the least
    score; the other kinds may need a context word. Repeated rows are searched each; an empty table gives no
    rows; an input column ``pii`` is replaced.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    out = docs.drop("pii")
    for steps in (lambda k: proposed(source, k), lambda k: scored(F.col(f"_pii_{k.name}"), k)):
        out = out.withColumns({f"_pii_{k.name}": steps(k) for k in kinds})
    out = out.withColumn("pii", F.concat(*(placed(F.col(f"_pii_{k.name}"), k) for k in kinds)))
    return out.drop(*(f"_pii_{k.name}" for k in kinds))


def spans_text(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact_pii(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, kind after kind.

    A null text stays null. Where spans of two kinds overlap, the kind listed first takes its characters.
    """
    out, pairs = docs, F.col("_pairs")
    for k in kinds:
        out = out.withColumn("_pairs", proposed(F.col(text), k)).withColumn("_scored", scored(pairs, k))
        out = out.withColumn(text, F.when(F.size("_scored") > 0, _replaced(pairs, F.col("_scored"), f"<{k.name.upper()}>")).otherwise(F.col(text)))
    return out.drop("_pairs", "_scored")


def _replaced(pairs: Column, scores: Column, mark: str) -> Column:
    """Gaps and matches put together again, ``mark`` for every match whose score is high enough."""

    def part(x: Column) -> Column:
        return F.concat(x["p"]["gap"], F.when(x["s"]["score"] >= LEAST_SCORE, F.lit(mark)).otherwise(F.coalesce(x["p"]["match"], F.lit(""))))

    return F.array_join(F.transform(F.arrays_zip(pairs.alias("p"), scores.alias("s")), part), "")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def only(found: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(found, lambda x: reduce(lambda a, b: a | b, [x["kind"] == k for k in kinds]))
