"""Personal data in texts: patterns propose spans, checksums confirm them, context words move the score.

Built-in expressions only, so detection stays in the JVM and moves no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read, whole_text

SPAN = "array<struct<start:int,end:int,value:string>>"
OUT = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


class Kind(NamedTuple):
    """``prior``: score of a confirmed match; ``context``: words that add ``gain`` when they stand within
    ``NEAR`` code points before or after it. ``ahead``: the pattern stands before a match without taking it
    and has it as group 1, so a match that is not confirmed hides no other."""

    name: str
    pattern: str
    confirm: object
    prior: float
    context: str
    gain: float = 0.3
    needs: str | None = None
    ahead: bool = False


NEAR = 40
THRESHOLD = 0.7


def _luhn(value: Column) -> Column:
    digits = F.filter(F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), ""), lambda c: c != "")
    doubled = F.transform(
        digits,
        lambda c, i: F.when(i % 2 == 0, c.cast("int"))
        .when(c.cast("int") > 4, c.cast("int") * 2 - 9)
        .otherwise(c.cast("int") * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _mod97(value: Column) -> Column:
    compact = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    letter = lambda a, c: (a * 100 + F.ascii(c) - 55) % 97
    step = lambda a, c: F.when(c == "", a).when(c.rlike("[0-9]"), (a * 10 + F.expr("0") + F.ascii(c) - 48) % 97).otherwise(letter(a, c))
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _digits(low: int, high: int):
    return lambda v: F.length(F.regexp_replace(v, "[^0-9]", "")).between(low, high)


_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Possessive loops match what the plain ones match (the next character never belongs to the loop) and
#: neither recurse nor back off; the look-behinds keep a long run from being tried at each of its places.
BASE = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, 0.9, r"mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda v: v.rlike(rf"^{_PART}(\.{_PART}){{3}}$"), 0.7, r"\bip\b|host|server|address"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda v: _digits(13, 19)(v) & _luhn(v), 0.8, r"card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _digits(9, 15), 0.7, r"phone|call|tel|mobile|fax"),
]
#: Signs of an account number by country, as the registry of ISO 13616 and its users list them.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _fixed() -> str:
    """Patterns of all lengths of ``LENGTHS``, in groups of four."""
    return "|".join(
        rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])"
        for n, codes in LENGTHS.items()
    )


#: Added kinds: an account number carries its own proof; the others need a context word to pass.
ADDED = [
    Kind("iban", rf"(?<![A-Za-z0-9])(?=((?:{_fixed()}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}+(?:\x20?[A-Z0-9]{{1,3}})?+)(?![A-Za-z0-9])))", _mod97, 0.8, r"iban|account|bank|konto", ahead=True),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", None, 0.5, r"ssn|social security|tax"),
    Kind("local_phone", r"(?<![0-9+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])", None, 0.5, r"phone|call|tel|mobile|fax"),
]


def _placed(text: Column, pattern: str, found: Column) -> Column:
    """Start and end (code points) of each match: lengths of the gaps between matches, summed up."""
    sized = F.zip_with(
        F.split(text, pattern, -1),
        found,
        lambda g, f: F.struct(F.char_length(g).alias("gap"), F.char_length(f).alias("n"), f.alias("value")),
    )
    start = lambda a, x: a["end"] + x["gap"]
    grow = lambda a, x: F.struct(
        (start(a, x) + x["n"]).alias("end"),
        F.concat(a["spans"], F.array(F.struct(start(a, x).alias("start"), (start(a, x) + x["n"]).alias("end"), x["value"].alias("value")))).alias("spans"),
    )
    begin = F.struct(F.lit(0).alias("end"), F.array().cast(SPAN).alias("spans"))
    return F.aggregate(sized, begin, lambda a, x: F.when(x["n"].isNull(), a).otherwise(grow(a, x)), lambda a: a["spans"])


def _placed_ahead(text: Column, pattern: str, found: Column) -> Column:
    """Start and end (code points) of each match of a pattern that takes no sign, ``found`` being its groups."""
    gaps = F.split(F.concat(F.lit(" "), text), pattern, -1)  # the sign before keeps the first gap
    sized = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, f: F.struct(F.char_length(g).alias("gap"), f.alias("value")))
    grow = lambda a, x: F.struct(
        (a["at"] + x["gap"]).alias("at"),
        F.concat(a["spans"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + F.char_length(x["value"])).alias("end"), x["value"].alias("value")))).alias("spans"),
    )
    begin = F.struct(F.lit(-1).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.aggregate(sized, begin, grow, lambda a: a["spans"])


def _apart(spans: Column) -> Column:
    """The spans that do not overlap one kept before them."""
    return F.aggregate(
        spans,
        F.array().cast(SPAN),
        lambda a, s: F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["end"] > s["start"]), a).otherwise(F.concat(a, F.array(s))),
    )


def find_pii(df: DataFrame, text: str = "text", output: str = "pii", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``output``: all spans ``(kind, start, end, value, score)`` by kind as listed, then start.

    Confirmed base matches (leftmost, not overlapping per kind) always stay; added kinds stay at
    ``threshold`` and where no base span overlaps them. Start and end count code points, end exclusive.
    Null and empty texts give an empty array. Other columns, repeated rows and row order are kept; a
    column already called ``output`` is replaced.
    """
    kinds = [*BASE, *ADDED]
    names = {k.name: f"__{k.name}" for k in kinds}
    whole = whole_text(text)
    none = F.array().cast("array<string>")

    def proposed(k: Kind) -> Column:
        found = F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(int(k.ahead)))
        return F.when(F.contains(whole, F.lit(k.needs)), found).otherwise(none) if k.needs else found

    hint = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}
    out = df.withColumns({names[k.name]: proposed(k._replace(needs=hint.get(k.name))) for k in kinds})

    def spans(k: Kind) -> Column:
        found = F.col(names[k.name])
        placed = (_placed_ahead if k.ahead else _placed)(whole, k.pattern, found)
        kept = F.filter(placed, lambda s: k.confirm(s["value"])) if k.confirm else placed
        kept = _apart(kept) if k.ahead else kept

        def scored(s: Column) -> Column:
            left = F.greatest(s["start"] - NEAR, F.lit(0))
            around = F.concat(F.substring(whole, left + 1, s["start"] - left), F.lit(" "), F.substring(whole, s["end"] + 1, F.lit(NEAR)))
            near = F.lower(around).rlike(k.context)
            score = F.least(F.lit(1.0), F.lit(k.prior) + F.when(near, F.lit(k.gain)).otherwise(F.lit(0.0)))
            return F.struct(F.lit(k.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), score.alias("score"))

        return F.when(F.size(found) > 0, F.transform(kept, scored)).otherwise(F.array().cast(OUT))

    out = out.withColumns({names[k.name]: spans(k) for k in kinds})
    base = F.concat(*[F.col(names[k.name]) for k in BASE])
    added = F.concat(*[F.col(names[k.name]) for k in ADDED])
    clear = lambda s: (s["score"] >= threshold) & ~F.exists("__base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    out = out.withColumns({"__base": base, "__added": added}).drop(*names.values())
    extra = F.when(F.size("__added") > 0, F.filter("__added", clear)).otherwise(F.array().cast(OUT))
    return out.withColumn(output, F.concat("__base", extra)).drop("__base", "__added")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii(spark, sf: str) -> DataFrame:
    """Spans in every whole text of ``documents``."""
    found = find_pii(read(spark, sf, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda s: s["kind"].isin([k.name for k in BASE]))
    return found.select(
        "doc_id",
        *[count(k.name) for k in BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
    )
