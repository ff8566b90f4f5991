"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust the score.

Base spans (email, ip, card, phone) stay whatever their score. More spans come from tighter patterns over the text
with the accepted base spans blanked out (a card or phone number within a longer run of digits), from IBANs that pass
mod 97, and from social security numbers whose score the words around them raise to the threshold. All of it is
column expressions; the time grows with the length of the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspan.llm.native import let, running

THRESHOLD, NEARBY, STEP = 0.5, 40, 0.25
BLANK = "\u0001"


@dataclass(frozen=True)
class Pattern:
    """kind, expression, score of a confirmed span, and words near it that raise and lower the score by STEP."""

    kind: str
    expression: str
    score: float
    raising: str
    lowering: str = "example|sample|test|dummy|version|isbn|order no"
    check: str = ""


# Starts are held to where a run begins (or the match before ended), and repeats take all they can: nothing else could
# match there either, and no text makes the search go back and forth.
BASE = (
    Pattern("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write|reach"),
    Pattern("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip|host|server|address|login|network", check="octets"),
    Pattern("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])", 0.7, "card|visa|master|credit|debit|payment|pay", check="luhn"),
    Pattern("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|tel|call|mobile|cell|fax|whatsapp", check="phone"),
)
MORE = (
    Pattern("card", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])", 0.6, BASE[2].raising, check="luhn"),
    Pattern("phone", r"\+[0-9]{1,3}[\x20.-]\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9])", 0.6, BASE[3].raising, check="phone"),
    Pattern("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", 0.8, "iban|account|bank|transfer|konto", check="mod97"),
    Pattern("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, "ssn|social security|taxpayer"),
)
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether 13 to 19 digits pass: every second from the right doubled, digit sums added, a multiple of 10."""
    def total(number: Column) -> Column:
        places = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.struct(F.try_to_number(c, F.lit("9")).cast("int").alias("d"), (i % 2).alias("odd")))
        return F.aggregate(places, F.lit(0), lambda acc, x: acc + F.when(x["odd"] == 0, x["d"]).otherwise(F.when(x["d"] > 4, x["d"] * 2 - 9).otherwise(x["d"] * 2)))

    return F.length(digits(text)).between(13, 19) & (total(digits(text)) % 10 == 0)


def mod97(text: Column) -> Column:
    """Whether an IBAN passes: its first four characters last, letters as 10 to 35, remainder 1."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))
    value = F.aggregate(F.split(moved, ""), F.lit(0), lambda acc, c: F.when(F.ascii(c) >= 65, (acc * 100 + F.ascii(c) - 55) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97))
    return F.length(plain).between(15, 34) & (value == 1)


def octets(text: Column) -> Column:
    return F.forall(F.split(text, r"\."), lambda x: F.length(F.regexp_replace(x, "^0+(?=[0-9])", "")).between(1, 3) & (F.lpad(F.regexp_replace(x, "^0+(?=[0-9])", ""), 3, "0") <= "255"))


CHECKS = {"luhn": luhn, "mod97": mod97, "octets": octets, "phone": lambda t: F.length(digits(t)).between(9, 15), "": lambda t: F.lit(True)}


def proposed(text: Column, pattern: Pattern) -> Column:
    """Every match of a pattern: match, start, whether its check passes, and its score with the words around it."""
    def all_of(v: Column) -> Column:
        starts = running(F.transform(v["found"], lambda m, i: (F.length(F.get(v["gaps"], i)) + F.length(m)).cast("long")))
        return let(scored, found=v["found"], gaps=v["gaps"], starts=starts)

    def scored(v: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            before, after = F.get(v["gaps"], i), F.get(v["gaps"], i + 1)
            near = F.lower(F.concat(F.right(before, F.lit(NEARBY)), F.lit(" "), F.left(after, F.lit(NEARBY))))
            shift = F.when(near.rlike(f"(?:^|[^a-z])(?:{pattern.raising})"), STEP).otherwise(0.0) - F.when(near.rlike(f"(?:^|[^a-z])(?:{pattern.lowering})"), STEP).otherwise(0.0)
            start = F.get(v["starts"], i) + F.length(before)
            return F.struct(m.alias("match"), start.alias("start"), CHECKS[pattern.check](m).alias("valid"), F.round(F.least(F.lit(1.0), F.lit(pattern.score) + shift), 2).alias("score"))

        return F.transform(v["found"], one)

    return let(all_of, found=F.regexp_extract_all(text, F.lit(pattern.expression), F.lit(0)), gaps=F.split(text, pattern.expression, -1))


def spans_of(matches: Column, pattern: Pattern, least: float) -> Column:
    kept = F.filter(matches, lambda m: m["valid"] & (m["score"] >= least))
    return F.transform(kept, lambda m: F.struct(F.lit(pattern.kind).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["match"])).alias("end"), m["score"].alias("score"))).cast(SPANS)


def blanked(text: Column, matches: Column, expression: str) -> Column:
    """The text with its accepted matches made of blanks of the same length."""
    def whole(v: Column) -> Column:
        parts = F.transform(v["gaps"], lambda g, i: F.concat(g, F.coalesce(F.when(F.get(v["matches"], i)["valid"], F.repeat(F.lit(BLANK), F.length(F.get(v["matches"], i)["match"]))).otherwise(F.get(v["matches"], i)["match"]), F.lit(""))))
        return F.concat_ws("", parts)

    return F.when(F.size(matches) > 0, let(whole, gaps=F.split(text, expression, -1), matches=matches)).otherwise(text)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base (the base spans) and found (all spans) of each row of docs (doc_id, text).

    A span is kind, start, end and score, in code points, the end exclusive; spans stand by kind (email, ip, card,
    phone, iban, ssn), then start. Null text counts as empty and has none. Rows that repeat are each scanned; an empty
    table gives no rows; other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for p in BASE:
        rows = rows.withColumn(f"base_{p.kind}", proposed(F.col("text"), p))
    cards, phones = (next(p for p in BASE if p.kind == k) for k in ("card", "phone"))
    rows = rows.withColumn("no_cards", blanked(F.col("text"), F.col("base_card"), cards.expression))
    rows = rows.withColumn("no_phones", blanked(F.col("text"), F.col("base_phone"), phones.expression))
    sources = {"card": "no_cards", "phone": "no_phones"}
    for p in MORE:
        rows = rows.withColumn(f"more_{p.kind}", proposed(F.col(sources.get(p.kind, "text")), p))
    base = {p.kind: spans_of(F.col(f"base_{p.kind}"), p, -1.0) for p in BASE}
    more = {p.kind: spans_of(F.col(f"more_{p.kind}"), p, threshold) for p in MORE}
    rows = rows.select("doc_id", *[v.alias(f"base_{k}") for k, v in base.items()], *[v.alias(f"more_{k}") for k, v in more.items()])
    every = [F.array_sort(F.concat(*[F.col(c) for c in (f"base_{k}", f"more_{k}") if c in rows.columns])) for k in KINDS]
    return rows.select("doc_id", F.concat(*[F.col(f"base_{p.kind}") for p in BASE]).alias("base"), F.concat(*every).alias("found"))
