"""Personal data by patterns, checksums and context, in DataFrame expressions only.

Patterns propose spans, validators confirm them (octets of an address, Luhn for cards,
mod 97 for bank accounts, digit counts for phones), words near a span move its score, and
spans that reach ``THRESHOLD`` are returned.

* email, ip, card, phone: proposed by the base patterns; a valid one starts above the
  threshold, so context can raise it but never drop it.
* iban: two letters, two check digits and 11 to 30 more signs; mod 97 decides.
* ssn, date_of_birth, passport: shapes that ordinary text has as well; they start below
  the threshold and need a context word nearby.

Positions come from the pieces between matches: a text is split at a pattern and the lengths
of pieces and matches are added up, so no Python code is needed and offsets count code
points. Patterns are written without backtracking (possessive runs, a look behind at the
start of a run), which finds the same leftmost matches in time linear in the text.

Defined cases: a null text counts as empty and has no spans; spans of different kinds may
overlap and all stay; texts of any length are read whole; rows that repeat an id are
scanned each for itself; an empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

THRESHOLD = 0.5
CHUNK = 256  # matches handled together
NEAR = 40  # code points of context on either side

# Patterns. A run that failed as a whole would fail from each of its places, so a match
# starts at the start of a run, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"  # whole runs of 14 to 19 digits
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
DATE = r"(?<![0-9])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9])"
PASSPORT = r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])"

# A cheap sign that a text may hold the kind at all.
SIGNS = {"email": "@", "phone": "+"}

# kind: (pattern, score of a valid proposal, context words, what they add)
KINDS = {
    "email": (EMAIL, 0.9, "mail|contact|write|adresse|correo|courriel", 0.1),
    "ip": (IP, 0.6, "ip|host|server|address|router", 0.3),
    "card": (CARD, 0.8, "card|visa|credit|karte|carte|tarjeta", 0.2),
    "phone": (PHONE, 0.7, "phone|tel|call|mobile|fax|telefon|telefono", 0.2),
    "iban": (IBAN, 0.9, "iban|account|konto|compte|cuenta", 0.1),
    "ssn": (SSN, 0.3, "ssn|social security|sozialversicherung", 0.5),
    "date_of_birth": (DATE, 0.1, "born|birth|dob|geboren|naissance|nacimiento", 0.6),
    "passport": (PASSPORT, 0.2, "passport|passeport|reisepass|pasaporte", 0.5),
}
BASE = ("email", "ip", "card", "phone")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits ends in its Luhn check digit."""
    signs = F.split(F.reverse(digits), "")
    values = F.transform(
        F.filter(signs, lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)),
    )
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def mod_97(account: Column) -> Column:
    """True if an account number without spaces leaves 1 modulo 97, its first four signs moved last."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    signs = F.filter(F.split(moved, ""), lambda c: c != "")
    step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(signs, F.lit(0), step) == 1


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.forall(F.split(found, r"\."), lambda part: (F.length(short(part)) <= 3) & (F.substring(short(part), 1, 3).cast("int") <= 255))
    if kind == "card":
        digits = _digits(found)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(found)).between(10, 15)
    if kind == "iban":
        plain = F.replace(found, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & mod_97(plain)
    return F.lit(True)


def _in_chunks(items: Column) -> Column:
    """An array as an array of arrays of at most ``CHUNK``, so that what grows item by item stays short."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / CHUNK).cast("int")), lambda i: F.slice(items, i * CHUNK + 1, F.lit(CHUNK)))


def _sums_before(values: Column) -> Column:
    """For every value the sum of those before it; for short arrays, since it copies as it goes."""
    begin = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, begin, lambda acc, v: F.struct((acc["sum"] + v).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")), lambda acc: acc["out"])


def _aligned(kind: str) -> list[Column]:
    """The piece before each match, the match, and the piece after it."""
    pieces, matches = F.col(f"__p_{kind}"), F.col(f"__m_{kind}")
    return [F.slice(pieces, F.lit(1), F.size(matches)).alias("piece"), matches.alias("match"), F.slice(pieces, F.lit(2), F.size(matches)).alias("after")]


def _placed(pairs: Column) -> Column:
    """Chunks of matches: array<struct<at, out>> of a chunk's length and its (start, end, match, near), counted from its start."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string,near:string>>").alias("out"))

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        near = F.concat(F.right(pair["piece"], F.lit(NEAR)), F.lit(" "), F.left(pair["after"], F.lit(NEAR)))
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"), F.lower(near).alias("near"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.transform(_in_chunks(pairs), lambda c: F.aggregate(c, begin, add))


def _proposed(chunks: Column) -> Column:
    """array<struct<start, end, match, near>> of a text, from its chunks."""
    before = _sums_before(F.transform(chunks, lambda c: c["at"]))
    moved = lambda c, by: F.transform(c["out"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["match"].alias("match"), s["near"].alias("near")))
    return F.flatten(F.zip_with(chunks, before, moved))


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def _confirmed(proposed: Column, kind: str) -> Column:
    """Spans of one kind that are valid and score high enough."""
    _, start, words, more = KINDS[kind]
    score = lambda s: F.least(F.lit(1.0), F.lit(start) + F.when(s["near"].rlike(rf"\b(?:{words})\b"), more).otherwise(0.0))
    kept = F.filter(proposed, lambda s: _valid(kind, s["match"]) & (score(s) >= THRESHOLD))
    return F.transform(
        kept,
        lambda s: F.struct(s["start"].alias("start"), F.lit(list(KINDS).index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), score(s).alias("score")),
    ).cast(SPAN)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: array of (start, rank, end, kind, score), by start and then kind.

    Offsets count code points of the text, the end is exclusive. No rows move.
    """
    own = [F.col(f"`{c}`") for c in docs.columns if c != "pii"]
    whole = F.coalesce(F.col(text), F.lit(""))
    sign = {kind: F.contains(whole, F.lit(SIGNS[kind])) if kind in SIGNS else F.col("__any") for kind in KINDS}
    matched = docs.select(*own, whole.rlike("[0-9]").alias("__any")).select(
        *own, *[F.when(sign[kind], F.regexp_extract_all(whole, F.lit(KINDS[kind][0]), F.lit(0))).alias(f"__m_{kind}") for kind in KINDS]
    )
    # Only texts with a match are read once more, for the pieces between matches.
    some = {kind: F.size(f"__m_{kind}") > 0 for kind in KINDS}
    split = matched.select(*own, *[f"__m_{kind}" for kind in KINDS], *[F.when(some[kind], F.split(whole, KINDS[kind][0], -1)).alias(f"__p_{kind}") for kind in KINDS])
    pairs = split.select(*own, *[F.when(some[kind], F.arrays_zip(*_aligned(kind))).alias(f"__a_{kind}") for kind in KINDS])
    placed = pairs.select(*own, *[F.when(F.col(f"__a_{kind}").isNotNull(), _placed(F.col(f"__a_{kind}"))).alias(f"__c_{kind}") for kind in KINDS])
    none = F.array().cast(SPAN)
    spans = [F.when(F.col(f"__c_{kind}").isNotNull(), _confirmed(_proposed(F.col(f"__c_{kind}")), kind)).otherwise(none) for kind in KINDS]
    return placed.select(*own, F.array_sort(F.concat(*spans)).alias("pii"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlaps are one span, named by the first.

    Spans are taken in chunks, each with its own part of the text: from where the spans before end to
    where its own do. What a lambda uses more than once is carried in its arguments, as
    anything else would be worked out anew for every item.
    """
    chunks = _in_chunks(spans)
    reach = F.transform(chunks, lambda c: F.coalesce(F.array_max(F.transform(c, lambda s: s["end"])), F.lit(0)))
    begin = F.struct(F.lit(0).alias("top"), F.array().cast("array<struct<base:int,top:int>>").alias("out"))

    def widen(acc: Column, end: Column) -> Column:
        top = F.greatest(acc["top"], end)
        return F.struct(top.alias("top"), F.concat(acc["out"], F.array(F.struct(acc["top"].alias("base"), top.alias("top")))).alias("out"))

    edges = F.aggregate(reach, begin, widen, lambda acc: acc["out"])

    def masked(c: Column, edge: Column) -> Column:
        own = F.substring(text, edge["base"] + 1, edge["top"] - edge["base"])
        start = F.struct(edge["base"].alias("at"), F.lit("").alias("out"), own.alias("own"), edge["base"].alias("base"))

        def add(acc: Column, s: Column) -> Column:
            skip = s["start"] < acc["at"]
            plain = F.substring(acc["own"], acc["at"] - acc["base"] + 1, s["start"] - acc["at"])
            return F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"),
                F.when(skip, acc["out"]).otherwise(F.concat(acc["out"], plain, F.lit("<"), F.upper(s["kind"]), F.lit(">"))).alias("out"),
                acc["own"].alias("own"),
                acc["base"].alias("base"),
            )

        return F.aggregate(c, start, add, lambda acc: acc["out"])

    parts = F.zip_with(chunks, edges, masked)
    last = F.element_at(edges, -1)["top"]
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(parts, ""), F.substring(text, last + 1, F.length(text))))
