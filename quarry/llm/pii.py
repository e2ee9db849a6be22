"""Personal data by patterns, checksum validators and context words.

Native expressions only.  A pattern proposes spans; a validator (Luhn for card
numbers, mod-97 for IBANs, value ranges for addresses, digit counts for phone
numbers) confirms or drops them; words close by raise the score.  Positions
come from cutting the text at the matches: the lengths of the pieces and of
the matches, added up, are the code-point offsets.

Two notes on the patterns.  Quantifiers are possessive where nothing that
follows could match what they take, which keeps Java's matcher from recursing
on very long runs.  A start inside a run of local-part characters (or of
digits) is tried only right behind the previous match (``\\G``): any other such
start would have failed at the run's first character already, and without this
a long run costs the square of its length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 256
BEFORE, AFTER = 48, 24
# A span of an added kind is reported from this score on; those of the four
# base kinds stay whatever their score.
LEAST_SCORE = 0.7


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _is_address(text: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return text.rlike(rf"^{part}(?:\.{part}){{3}}$")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (spaces allowed) leaves 1 modulo 97."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c < 58, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _is_card(text: Column) -> Column:
    d = _digits(text)
    return F.length(d).between(12, 19) & luhn(d)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    holds: str  # a character that every match holds
    valid: Callable[[Column], Column] | None
    checked: bool  # the validator is a checksum
    score: float
    context: tuple[str, ...]


# Base patterns as the contract gives them, and context words.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", None,
         False, 0.7, ("mail", "contact", "write", "correo", "courriel")),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", _is_address,
         False, 0.6, ("ip", "address", "host", "server", "adresse")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", _is_card,
         True, 0.4, ("card", "visa", "master", "credit", "karte", "tarjeta", "carte")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", lambda t: F.length(_digits(t)).between(9, 15),
         False, 0.6, ("phone", "call", "tel", "mobile", "fax")),
)
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
         r"(?![A-Za-z0-9])", "", mod97, True, 0.4, ("iban", "account", "bank", "konto", "cuenta", "compte")),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "-", None,
         False, 0.3, ("ssn", "social security")),
)


def _ends(hits: Column, gaps: Column) -> Column:
    """Where each match ends.  Running sums in chunks: appending to one array
    would cost the square of the number of matches."""
    lens = F.transform(hits, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("long"))
    chunks = F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / CHUNK).cast("int"))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def part(c: Column) -> Column:
        return F.slice(lens, c * CHUNK + 1, F.lit(CHUNK))

    def running(items: Column, start: Column) -> Column:
        return F.aggregate(
            items, F.struct(start.alias("at"), none.alias("out")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"),
                                    F.concat(acc["out"], F.array(acc["at"] + x)).alias("out")),
            lambda acc: acc["out"])

    totals = F.transform(chunks, lambda c: F.aggregate(part(c), zero, lambda a, x: a + x))
    after = running(totals, zero)
    return F.flatten(F.transform(chunks, lambda c: running(
        part(c), F.when(c == 0, zero).otherwise(F.get(after, c - 1)))))


def _context(words: tuple[str, ...], near: Column) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(near, F.lit(w))
    return out


def _spans(kind: Kind, order: int, least: float | None) -> Column:
    hits, gaps, ends = F.col(f"hits_{kind.name}"), F.col(f"gaps_{kind.name}"), F.col(f"ends_{kind.name}")
    gain = 0.4 if kind.checked else 0.0

    def span(m: Column, i: Column) -> Column:
        near = F.lower(F.concat(F.right(F.get(gaps, i), F.lit(BEFORE)), F.lit(" "),
                                F.left(F.get(gaps, i + 1), F.lit(AFTER))))
        score = F.lit(kind.score + gain) + F.when(_context(kind.context, near), 0.4).otherwise(0.0)
        end = F.get(ends, i)
        return F.struct((end - F.length(m)).alias("start"), F.lit(order).alias("rank"), F.lit(kind.name).alias("kind"),
                        end.alias("end"), m.alias("text"), F.least(score, F.lit(1.0)).alias("score"))

    out = F.transform(hits, span)
    if kind.valid:
        out = F.filter(out, lambda s: kind.valid(s["text"]))
    if least is not None:
        out = F.filter(out, lambda s: s["score"] >= least)
    return F.when(F.size(hits) > 0, out).otherwise(F.array().cast(
        "array<struct<start:bigint,rank:int,kind:string,end:bigint,text:string,score:double>>"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id and ``found``, an array of
    struct(start, rank, kind, end, text, score) by start, then kind as listed;
    offsets in code points, end exclusive.

    Matches of a kind are leftmost and do not overlap; a match that its
    validator refuses is dropped, without another try inside it.  Kinds may
    overlap each other.  A null or empty text has none; repeated rows are
    searched each; a null doc_id is kept; an empty table gives no rows; other
    columns are ignored."""
    kinds = BASE + ADDED
    df = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")

    def hits(k: Kind) -> Column:
        found = F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))
        return F.when(F.contains(F.col("text"), F.lit(k.holds)), found).otherwise(none) if k.holds else found

    df = df.select("*", *[hits(k).alias(f"hits_{k.name}") for k in kinds])
    df = df.select("*", *[F.when(F.size(f"hits_{k.name}") > 0, F.split("text", k.pattern, -1))
                          .alias(f"gaps_{k.name}") for k in kinds])
    df = df.select("*", *[F.when(F.size(f"hits_{k.name}") > 0, _ends(F.col(f"hits_{k.name}"), F.col(f"gaps_{k.name}")))
                          .alias(f"ends_{k.name}") for k in kinds])
    found = [_spans(k, i, LEAST_SCORE if k in ADDED else None) for i, k in enumerate(kinds)]
    return df.select("doc_id", F.array_sort(F.concat(*found)).alias("found"))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the
    base kinds' kind:start:end, comma-joined) and spans (all kinds, joined
    likewise).  Rows as in ``find_personal_data``."""
    found = find_personal_data(docs)

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(name: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *[count(k.name) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))
