"""Personal data in texts: patterns propose, checksums confirm, nearby words adjust; DataFrame operations only.

Method
    Emails, IP addresses, card numbers, phone numbers and IBANs are found by patterns, leftmost and without
    overlap for each kind. Cards must pass Luhn, IBANs mod-97, IP parts the range 0 to 255, phones a number of
    digits; what fails is dropped. A span starts with its kind's score, which a telling word close by raises
    and a contrary word lowers.

Scale
    All work is in one row's expressions, inside one stage without a shuffle. Positions come from the pieces
    between matches, so the text is read a fixed number of times. The patterns are written so that each
    character is tried once from the start of its run, not once from every start inside it, and none of them
    nests a repetition that Java would match by recursion; they find exactly the spans of the plain patterns
    in the docstring of ``find_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]
NEAR_CHARS = 40
MIN_SCORE = 0.55  # an IBAN with a contrary word close by needs a telling one too

_JOINT = "\u0001"  # stands for a single blank or hyphen between two digits
# fixed values: the patterns of the kinds
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"(?<![0-9{_JOINT}])(?=(?:[0-9]{_JOINT}?){{14}})[0-9{_JOINT}]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
}
#: where an IBAN may start: its own run of letters and digits is taken in, groups after a blank are not
_IBAN_START = r"[A-Z]{2}[0-9]{2}(?=[A-Z0-9]{11}|(?: [A-Z0-9]{4}){2})[A-Z0-9]{0,30}+"
_IBAN_CHARS = 44  # no match is longer
_IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
                 22: "BG BH CR DE GB GE IE ME RS", 23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN", 25: "PT",
                 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR", 30: "MU", 31: "MT"}
_SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9}
_RAISE = {"email": "mail|contact|write to", "ip": r"\bip\b|address|host|server", "card": "card|visa|credit|payment",
          "phone": "phone|tel|call|mobile|fax", "iban": "iban|account|bank|transfer"}
_LOWER = {"email": "example", "ip": "version|release", "card": "order|serial|isbn", "phone": "version|serial", "iban": "serial|part no"}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def add(total: Column, k: Column) -> Column:
        d = F.substr(backwards, k, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(k % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an IBAN, with or without blanks, has the remainder 1."""
    plain = F.regexp_replace(code, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def add(rest: Column, k: Column) -> Column:
        c = F.ascii(F.substr(moved, k, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    sized = F.length(plain).between(15, 34)
    return sized & (F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1)


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _iban_in(window: Column) -> Column:
    """The IBAN that ``window`` starts with, or null: the longest match or the longest part of it up to a blank
    that passes mod-97; one of the country's length goes before longer ones."""
    parts = F.split(F.regexp_extract(window, "^" + _PATTERNS["iban"], 0), " ")
    endings = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, F.size(parts) - k), " "))
    passing = F.filter(endings, mod97)
    of_country = "^(?:" + "|".join(f"(?:{names.replace(' ', '|')})[A-Z0-9]{{{n - 2}}}" for n, names in _IBAN_LENGTHS.items()) + ")$"
    usual = F.filter(passing, lambda v: F.regexp_replace(v, " ", "").rlike(of_country))
    return F.coalesce(F.get(usual, F.lit(0)), F.get(passing, F.lit(0)))


def _ibans(text: Column, placed: Column) -> Column:
    """Of the starts ``placed`` those of an IBAN that no earlier one covers, with its end, value and neighbourhood."""
    tried = F.filter(F.transform(placed, lambda m: F.struct(
        m["start"].alias("start"), _iban_in(F.substr(text, m["start"] + 1, F.lit(_IBAN_CHARS))).alias("value"))), lambda m: m["value"].isNotNull())
    blank = F.array().cast("array<struct<start:int,end:int,before:string,after:string,value:string>>")

    def step(state: Column, m: Column) -> Column:
        end, first = m["start"] + F.length(m["value"]), F.greatest(m["start"] - NEAR_CHARS, F.lit(0))
        own = F.struct(m["start"].alias("start"), end.alias("end"), F.substr(text, first + 1, m["start"] - first).alias("before"),
                       F.substr(text, end + 1, F.lit(NEAR_CHARS)).alias("after"), m["value"].alias("value"))
        fresh = m["start"] >= state["at"]
        return F.struct(F.when(fresh, end).otherwise(state["at"]).alias("at"),
                        F.when(fresh, F.concat(state["spans"], F.array(own))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(tried, F.struct(F.lit(0).alias("at"), blank.alias("spans")), step)["spans"]


def _spans(text: Column, seen: Column, kind: str) -> Column:
    """All confirmed spans of a kind. ``seen`` is the text, or a form of it with the same positions."""
    pattern = _IBAN_START if kind == "iban" else _PATTERNS[kind]
    found, between = F.regexp_extract_all(seen, F.lit(pattern), 0), F.split(seen, pattern, -1)
    at = F.arrays_zip(found.alias("value"), F.slice(between, 1, F.size(found)).alias("before"), F.slice(between, 2, F.size(found)).alias("after"))
    blank = F.array().cast("array<struct<start:int,end:int,before:string,after:string,value:string>>")

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["before"])
        end = start + F.length(m["value"])
        own = F.struct(start.alias("start"), end.alias("end"), F.right(m["before"], F.lit(NEAR_CHARS)).alias("before"),
                       F.left(m["after"], F.lit(NEAR_CHARS)).alias("after"), m["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(own)).alias("spans"))

    placed = F.aggregate(at, F.struct(F.lit(0).alias("at"), blank.alias("spans")), step)["spans"]
    if kind == "iban":
        placed = _ibans(text, placed)

    def scored(m: Column) -> Column:
        near = F.lower(F.concat_ws(" ", m["before"], m["after"]))
        score = F.lit(_SCORES[kind]) + F.when(near.rlike(_RAISE[kind]), 0.1).otherwise(0.0) - F.when(near.rlike(_LOWER[kind]), 0.4).otherwise(0.0)
        return F.struct(m["start"].cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].cast("long").alias("end"),
                        F.lit(kind).alias("kind"), F.round(score, 2).alias("score"))

    return F.transform(F.filter(placed, lambda m: _valid(kind, m["value"])), scored)


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with ``out``: structs of start, rank, end, kind and score, by start and then kind as listed.

    Positions are code points from 0, the end exclusive. A null or empty text has no spans. Spans of different
    kinds may overlap. Base kinds, which always stay:

    - email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
    - ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at most 255
    - card ``[0-9]([\\x20-]?[0-9])+``, 14 to 19 digits, Luhn
    - phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 10 to 15 digits

    Of the other kind, iban, spans stay whose mod-97 and score hold. Context decides on this kind alone.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    jointed = F.regexp_replace(F.translate(whole, _JOINT, "x"), r"(?<=[0-9])[\x20-](?=[0-9])", _JOINT)
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>")
    worth = {"email": F.instr(whole, "@") > 0, "phone": F.instr(whole, "+") > 0, "ip": whole.rlike(r"[0-9]\.[0-9]"),
             "card": whole.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), "iban": whole.rlike("[A-Z]{2}[0-9]{2}[A-Z0-9 ]")}
    lists = [F.when(worth[k], _spans(whole, jointed if k == "card" else whole, k)).otherwise(none) for k in KINDS]
    kept = F.filter(F.concat(*lists), lambda s: (s["rank"] < len(BASE_KINDS)) | (s["score"] >= min_score))
    return docs.withColumn(out, F.array_sort(kept))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in capitals; spans that overlap are replaced together."""
    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        piece = F.concat(F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(F.greatest(state["at"], s["end"]).cast("int").alias("at"),
                        F.when(fresh, F.concat(state["done"], F.array(piece))).otherwise(state["done"]).alias("done"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("done"))
    ints = F.transform(spans, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), s["kind"].alias("kind")))
    end = F.aggregate(ints, start, step)
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(end["done"], ""), F.substr(text, end["at"] + 1)))
