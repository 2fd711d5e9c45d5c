"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score. Columns only, no Python."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .columns import spare

THRESHOLD = 0.5
NEAR = 48
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "short_card", "secret", "ssn", "local_phone")

# The patterns, in possessive form. A match begins where its run of characters does, or where the last match
# ended: that gives the leftmost matches and keeps long runs linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
    "short_card": r"[0-9](?:[ -]?[0-9])++",
    "secret": r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,64}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}",
}
# The characters that a match must not touch.
APART = {"iban": "[A-Za-z0-9]", "local_phone": "[0-9+(-]"}
# The score of a pattern with its checksum met, and the words nearby that add to it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "short_card": 0.3, "secret": 0.3, "ssn": 0.4, "local_phone": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account"),
    "short_card": ("card", "visa", "amex", "credit", "payment"),
    "secret": ("token", "secret", "key", "password", "auth"),
    "ssn": ("ssn", "social", "security"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"),
}
CONTEXT_SCORE = 0.3

_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_FOUND = "array<struct<start:int,end:int,body:string>>"
#: A text is cut into pieces of so many code points, so that what is at a place is found without going through the text.
_PIECE = 1024
#: A scan goes through so many values at a time, as each of its steps copies what it has of these.
_RUN = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` has it, in lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(items: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """The states (of type ``kind``) after each of the items, of which ``step`` makes the next one from the last one and an item."""
    return _let(items, lambda them: _states(them, zero, step, kind))


def _states(items: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _RUN).cast("int")), lambda k: F.slice(items, k * _RUN + 1, F.lit(_RUN)))
    last = lambda states: F.element_at(states, -1)

    def through(done: Column, run: Column) -> Column:
        states = F.aggregate(run, F.array(last(last(done))), lambda states, x: F.concat(states, F.array(step(last(states), x))))
        return F.concat(done, F.array(states))

    # Each run's states begin with the last one of the run before.
    every = F.aggregate(runs, F.array(F.array(zero)), through)
    states = F.flatten(F.transform(every, lambda states: F.slice(states, 2, F.greatest(F.size(states) - 1, F.lit(0)))))
    return F.when(F.size(items) > 0, states).otherwise(F.array().cast(f"array<{kind}>"))


def _matches(text: Column, pattern: str) -> Column:
    """Start, end (code points) and body of every match: what lies between the matches gives their places."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    bodies = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = _let(bodies, lambda them: F.zip_with(them, F.slice(gaps, 1, F.size(them)), lambda b, g: F.struct(b.alias("body"), g.alias("gap"))))
    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("body"))

    def step(last: Column, pair: Column) -> Column:
        start = last["end"] + pair["gap"]
        return F.struct(start.alias("start"), (start + F.length(pair["body"])).alias("end"), pair["body"].alias("body"))

    return _scan(pairs, zero, step, _FOUND.removeprefix("array<")[:-1])


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))


def _part(pieces: Column, start: Column, end: Column) -> Column:
    """The text from start to before end, both in code points, out of its pieces; what is beyond the text's ends is left out."""
    start, end = F.greatest(start, F.lit(0)), F.greatest(start, end)
    first = F.floor(start / _PIECE).cast("int")
    near = F.array_join(F.slice(pieces, first + 1, F.floor(end / _PIECE).cast("int") - first + 1), "")
    return F.substring(near, start % _PIECE + 1, end - start)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    value = lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: value(F.ascii(c) - 48, i))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces has the remainder 1."""
    turned = F.concat(F.substring(iban, 5, 100), F.substring(iban, 1, 4))
    letters = F.filter(F.split(turned, ""), lambda c: c != "")
    value = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    return F.aggregate(letters, F.lit(0), lambda a, c: (a * F.when(c >= "A", 100).otherwise(10) + value(c)) % 97) == 1


def _octet(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(short) <= 3) & (F.lpad(short, 3, "0") <= "255")


def _apart(kind: str, pieces: Column, m: Column) -> Column:
    """Whether the characters next to a match aren't of the sort that it must not touch."""
    before, after = F.when(m["start"] > 0, _part(pieces, m["start"] - 1, m["start"])).otherwise(""), _part(pieces, m["end"], m["end"] + 1)
    return ~before.rlike(APART[kind]) & ~after.rlike(APART[kind])


def _valid(kind: str, pieces: Column, m: Column) -> Column:
    body = m["body"]
    digits = _digits(body)
    size = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": F.forall(F.split(body, r"\."), _octet),
        "card": size.between(16, 19) & luhn(digits),
        "phone": size.between(8, 15),
        "iban": _apart("iban", pieces, m) & mod97(F.replace(body, F.lit(" "), F.lit(""))),
        "short_card": size.between(13, 15) & luhn(digits),
        "secret": F.lit(True),
        "ssn": ~F.substring(body, 1, 3).isin("000", "666") & (F.substring(body, 1, 1) != "9"),
        "local_phone": _apart("local_phone", pieces, m),
    }[kind]


def _spans(text: Column, pieces: Column, kind: str) -> Column:
    """The confirmed spans of one kind with their scores; added kinds need the threshold."""
    found = F.filter(_matches(text, PATTERNS[kind]), lambda m: _valid(kind, pieces, m))

    def scored(m: Column) -> Column:
        from_ = F.greatest(m["start"] - NEAR, F.lit(0))
        near = F.lower(F.concat(_part(pieces, from_, m["start"]), F.lit(" "), _part(pieces, m["end"], m["end"] + NEAR)))
        told = reduce(lambda a, b: a | b, [F.contains(near, F.lit(w)) for w in CONTEXT[kind]])
        score = F.lit(SCORES[kind]) + F.when(told, CONTEXT_SCORE).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.round(F.least(score, F.lit(1.0)), 2).alias("score"))

    spans = F.transform(found, scored)
    if kind in ADDED:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    may = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(PATTERNS[kind])
    return F.when(may, spans).otherwise(F.array().cast(_SPANS))


def _overlaps(span: Column, spans: Column) -> Column:
    """Whether a span overlaps one of ``spans``, which are in order and apart: the last that begins before it ends tells."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(25))])
    before = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.coalesce(F.try_element_at(spans, at + s)["start"] < span["end"], F.lit(False)), at + s).otherwise(at))
    return F.coalesce(F.get(spans, before - 1)["end"] > span["start"], F.lit(False))


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and pii, the array of (kind, start, end, score) in every whole text: base kinds first, then by start.

    Base spans stay whatever their score; an added span goes if it overlaps a base span. A null text is empty; repeated rows
    each have their spans; a long text is searched in whole, in time that grows as its length and its matches do; an empty table gives no
    rows. A column named pii is replaced, and other names never clash.
    """
    docs = docs.drop("pii")
    kinds = (*BASE, *ADDED)
    text, digit, pieces, *names = spare(docs, "body", "digit", "pieces", *kinds)
    of = dict(zip(kinds, names, strict=True))
    none = F.array().cast(_SPANS)
    out = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit(""))).withColumn(digit, F.col(text).rlike("[0-9]"))
    asked = F.col(digit) | F.contains(text, F.lit("@"))
    out = out.withColumn(pieces, F.when(asked, _pieces(F.col(text))).otherwise(F.array().cast("array<string>")))
    own = lambda k: _spans(F.col(text), F.col(pieces), k)
    out = out.withColumns({of[k]: own(k) if k == "email" else F.when(F.col(digit), own(k)).otherwise(none) for k in kinds})
    clear = [F.filter(F.col(of[k]), lambda s: reduce(lambda a, b: a & ~_overlaps(s, F.col(of[b])), BASE, F.lit(True))) for k in ADDED]
    return out.select(*docs.columns, F.concat(*[F.col(of[k]) for k in BASE], *clear).alias("pii"))


def digest(pii: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(pii, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in brackets; spans that overlap an earlier one go with it."""
    found = find(docs, text_col)
    spans, pieces, kept = spare(found, "spans", "pieces", "kept")
    sorted_ = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    found = found.withColumns({spans: sorted_, pieces: _pieces(F.col(text_col))})
    # What is left before each span that stays, and its kind; a span that is overlapped leaves nothing.
    zero = F.struct(F.lit(0).alias("from"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("kind"), F.lit(False).alias("stays"))

    def step(last: Column, s: Column) -> Column:
        stays = s["start"] >= last["end"]
        return F.struct(last["end"].alias("from"), s["start"].alias("start"), F.when(stays, s["end"]).otherwise(last["end"]).alias("end"), s["kind"].alias("kind"), stays.alias("stays"))

    states = _scan(F.col(spans), zero, step, "struct<from:int,start:int,end:int,kind:string,stays:boolean>")
    found = found.withColumn(kept, F.filter(states, lambda s: s["stays"]))
    body = F.transform(kept, lambda s: F.concat(_part(F.col(pieces), s["from"], s["start"]), F.lit("["), s["kind"], F.lit("]")))
    end = F.coalesce(F.get(kept, F.size(kept) - 1)["end"], F.lit(0))
    text = F.concat(F.array_join(body, ""), _part(F.col(pieces), end, F.length(text_col)))
    return found.withColumn(text_col, F.when(F.size("pii") > 0, text).otherwise(F.col(text_col))).drop(spans, pieces, kept)
