"""Personal data in whole texts, in Spark's own expressions only.

Patterns propose spans, validators confirm them (Luhn for cards, mod 97 for IBANs, ranges for addresses and social
security numbers), and context words shortly before a span raise or lower its score.  Spans of the base kinds
(email, ip, card, phone) stay whatever their score; the other kinds need ``KEEP``.

Positions are code points, the end exclusive.  Spark gives matches without positions, so a text is split at the
pattern as well: the running sum of the lengths of gaps and matches places every match.  All of it is a projection
of the row: no shuffle, no Python.

The patterns find what their plain forms find, leftmost and non-overlapping, in linear time also on long runs of
one character class: quantifiers are possessive where what follows cannot match inside, and a search starts only
where a run starts (or where the match before ended).

Edge cases: a null text is empty and gives an empty array; rows are independent, so copies and ties give equal
results; an empty table gives an empty table; a column of the input named like a result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collabstats.llm.native import let, running

#: Score that a span of a kind outside the base needs.
KEEP = 0.5
#: Code points before a span in which context words count.
NEAR = 40


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    prior: float
    words: str  # context that raises the score
    boost: float
    base: bool = True
    against: str = ""  # context that lowers it by as much
    needs: str = ""  # cheap test that a text has to pass before the pattern runs


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, r"e-?mail|contact|correo|courriel|kontakt", 0.1, needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+", 0.6, r"ip|host|server|address|adresse|client", 0.3, against=r"version|release|v", needs="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){13,}+", 0.8, r"card|visa|credit|debit|carte|tarjeta|karte", 0.2),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, r"call|tel|phone|mobile|fax|telefon|appel", 0.3, needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])", 0.8, r"iban|bank|account|konto|compte|cuenta", 0.2, base=False),
    Kind("ssn", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", 0.3, r"ssn|social|security", 0.4, base=False, needs="-"),
)
BASE = tuple(k.name for k in KINDS if k.base)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's checksum."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda a, i: a + let(F.substr(F.reverse(digits), i, F.lit(1)).cast("int"), lambda d: F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks leaves 1 when its digits (letters from 10 on) are divided by 97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    total = let(turned, lambda t: F.aggregate(
        F.sequence(F.lit(1), F.length(t)), F.lit(0),
        lambda a, i: let(F.ascii(F.substr(t, i, F.lit(1))), lambda c: F.when(c >= 65, (a * 100 + c - 55) % 97).otherwise((a * 10 + c - 48) % 97))))
    return total == 1


def _valid(kind: Kind, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind.name == "ip":
        return F.forall(F.split(found, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda z: (F.length(z) < 3) | ((F.length(z) == 3) & (z <= "255"))))
    if kind.name == "card":
        return let(digits, lambda d: F.length(d).between(14, 19) & F.when(F.length(d) <= 19, luhn(d)).otherwise(False))
    if kind.name == "phone":
        return F.length(digits).between(10, 15)
    if kind.name == "iban":
        return let(F.regexp_replace(found, " ", ""), mod97)
    if kind.name == "ssn":
        return ~found.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _score(kind: Kind, text: Column, start: Column) -> Column:
    near = F.lower(F.substr(text, (F.greatest(start - NEAR, F.lit(0)) + 1).cast("int"), F.least(start, F.lit(NEAR)).cast("int")))
    score = F.lit(kind.prior) + F.when(near.rlike(rf"\b(?:{kind.words})\b"), kind.boost).otherwise(0.0)
    if kind.against:
        score = score - F.when(near.rlike(rf"\b(?:{kind.against})\b"), kind.boost).otherwise(0.0)
    return F.round(score, 4)


SPAN = "struct<start:bigint,place:int,end:bigint,kind:string,value:string,score:double,base:boolean>"


def _spans(kind: Kind, place: int, text: Column) -> Column:
    """The kind's confirmed spans."""
    none = F.array().cast(f"array<{SPAN}>")

    def placed(gaps: Column, found: Column) -> Column:
        steps = F.transform(found, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("bigint"))
        return let(running(steps, "sum"), lambda ends: F.transform(found, lambda m, i: F.struct(
            (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("value"))))

    def confirmed(found: Column) -> Column:
        spans = let(F.split(text, kind.pattern, -1), lambda gaps: placed(gaps, found))
        kept = F.filter(spans, lambda s: _valid(kind, s["value"]))
        scored = F.transform(kept, lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind.name).alias("kind"),
            s["value"].alias("value"), _score(kind, text, s["start"]).alias("score"), F.lit(kind.base).alias("base")))
        return (scored if kind.base else F.filter(scored, lambda s: s["score"] >= KEEP)).cast(f"array<{SPAN}>")

    all_found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, confirmed(found)).otherwise(none))
    return F.when(F.contains(text, F.lit(kind.needs)), all_found).otherwise(none) if kind.needs else all_found


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: its spans, by start and then kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    digits = [k for k in KINDS if k.name != "email"]
    mail = _spans(KINDS[0], 0, whole)
    rest = F.concat(*(_spans(k, KINDS.index(k), whole) for k in digits))
    spans = F.concat(mail, F.when(whole.rlike("[0-9]"), rest).otherwise(F.array().cast(f"array<{SPAN}>")))
    return docs.withColumn("pii", F.array_sort(spans))


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """``found`` with each span of ``pii`` replaced by its kind in brackets; overlapping spans become one."""
    whole, spans = F.col(text), F.col("pii")
    tops = running(F.transform(spans, lambda s: s["end"]), "max")
    parts = let(tops, lambda top: let(F.transform(spans, lambda s, i: F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(top, i - 1))), lambda done: F.concat(
        F.transform(spans, lambda s, i: F.when(s["start"] >= F.get(done, i), F.concat(
            F.substr(whole, (F.get(done, i) + 1).cast("int"), (s["start"] - F.get(done, i)).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")),
        F.array(F.substr(whole, (F.element_at(top, -1) + 1).cast("int"))))))
    return found.withColumn(text, F.when(F.size(spans) > 0, F.array_join(parts, "")).otherwise(whole))


def digest(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
