"""Personal data by patterns, checksums and context, in DataFrame functions only.

Patterns propose spans, validators confirm them (parts of an address at most 255, Luhn, digit counts,
mod 97), and words within ``CONTEXT`` characters before or after a span adjust its score: words of its kind
raise it, words of trade numbers (``COUNTER``) lower it. The base kinds (email, ip, card, phone) are kept
whenever they are valid, whatever their score; the added kinds (iban, ssn) need a score of ``LEAST``: a bank
account number has it unless counter words stand near it, a social security number only beside a word of
its kind. All of it is one projection over each row; nothing is shuffled. The patterns use possessive
quantifiers and look at each run of characters once, so they are linear in the text; they find exactly what
the plain greedy patterns find. Offsets are running sums in two levels, and stretches of a text are taken
from blocks of it, so many spans in a long text stay cheap.

Defined cases: a null text is the empty text and has no spans (and stays null when masked); spans of one kind
do not overlap, spans of different kinds may; offsets count code points, end exclusive; ties in start go by
the order of kinds; repeated rows are treated one by one; an empty table gives no rows; columns other than
doc_id, text and, for masking, n_chars are not touched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
LEAST = 0.5
STEP = 0.3
COUNTER = "order|invoice|isbn|serial|sku|version|tracking|part"
#: Code points of a block of text, and values of a block of running sums.
BLOCK, RUN = 4096, 128
#: kind, pattern, cheap condition that any text with a match meets, start score, context words.
KINDS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write|schreib|correo"),
    ("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", 0.6, "ip|address|host|server|adresse"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.8, "card|visa|credit|karte|carte|tarjeta"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, "phone|call|tel|fax|mobile"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", "", 0.7, "iban|account|bank|konto|compte|cuenta"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, "ssn|social|security"),
)
BASE = ("email", "ip", "card", "phone")
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def luhn(digits: Column) -> Column:
    d = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.try_to_number(x, F.lit("9")).cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    return F.aggregate(d, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def mod_97(account: Column) -> Column:
    compact = F.regexp_replace(account, r"\x20", "")
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97) == 1


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        "card": lambda: F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False),
        "phone": lambda: F.length(digits).between(10, 15),
        "iban": lambda: mod_97(value),
        "ssn": lambda: ~value.rlike("^(?:000|666|9)|-00-|-0000$"),
    }[kind]()


def _may_hold(kind: str, needs: str, text: Column) -> Column:
    cheap = F.contains(text, F.lit(needs)) if needs else F.lit(True)
    return cheap if kind == "email" else cheap & text.rlike("[0-9]")


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)``, where the value is computed once however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """The fold of each element and those before it, from 0; in blocks, as an array grows by copying."""
    grow = lambda acc, v: F.concat(acc, F.array(op(F.element_at(acc, -1), v)))
    zero = F.lit(0)

    def blocks(x: Column) -> Column:
        last = F.floor(F.greatest(F.size(x) - 1, zero) / RUN).cast("int")
        return F.transform(F.sequence(zero, last), lambda b: F.slice(x, b * RUN + 1, RUN))

    def joined(bs: Column) -> Column:
        starts = F.aggregate(F.transform(bs, lambda b: F.aggregate(b, zero, op)), F.array(zero), grow)
        return _let(starts, lambda s: F.flatten(F.zip_with(bs, F.slice(s, 1, F.size(bs)), lambda b, at: F.slice(F.aggregate(b, F.array(at), grow), 2, RUN))))

    return _let(values, lambda x: _let(blocks(x), joined))


def _stretch(blocks: Column, start: Column, length: Column) -> Column:
    """Code points of a text that is given in blocks; empty where the length isn't positive."""
    first = F.floor(start / BLOCK).cast("int")
    many = F.floor((start + length - 1) / BLOCK).cast("int") - first + 1
    inside = F.substring(F.array_join(F.slice(blocks, first + 1, F.greatest(many, F.lit(0))), ""), start % BLOCK + 1, length)
    return F.when(length > 0, inside).otherwise("")


def _in_blocks(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int")), lambda b: F.substring(text, b * BLOCK + 1, F.lit(BLOCK)))


_SPAN = "array<struct<start:int,no:int,kind:string,end:int,score:double>>"


def _found(no: int, text: Column) -> Column:
    """The matches of a kind and the parts of the text between them, with what the kind's facts are; null without a match."""
    kind, pattern, needs, start_score, _ = KINDS[no]
    parts, values = F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")
    facts = F.lit(no).alias("no"), F.lit(kind).alias("kind"), F.lit(start_score).alias("start_score")
    return F.when(_may_hold(kind, needs, text) & text.rlike(pattern), F.struct(*facts, parts, values))


def _by_kind(no: Column, f: Callable[[int], Column]) -> Column:
    """``f`` of the kind's number."""
    out = F.when(no == 0, f(0))
    for k in range(1, len(KINDS)):
        out = out.when(no == k, f(k))
    return out


def _placed(both: Column, blocks: Column) -> Column:
    """The spans of one kind's matches."""
    no = both["no"]

    def described(v: Column, end: Column) -> Column:
        start = end - F.length(v)
        before = _stretch(blocks, F.greatest(start - CONTEXT, F.lit(0)), F.least(start, F.lit(CONTEXT)))
        near = F.lower(F.concat(before, F.lit(" # "), _stretch(blocks, end, F.lit(CONTEXT))))

        def score(near: Column) -> Column:
            own = _by_kind(no, lambda k: near.rlike(rf"\b(?:{KINDS[k][4]})"))
            step = F.when(own, STEP).otherwise(0.0) - F.when(near.rlike(rf"\b(?:{COUNTER})\b"), STEP).otherwise(0.0)
            return F.round(F.least(F.greatest(both["start_score"] + step, F.lit(0.0)), F.lit(1.0)), 2)

        ok = _by_kind(no, lambda k: valid(KINDS[k][0], v)).alias("ok")
        return F.struct(start.alias("start"), no.alias("no"), both["kind"].alias("kind"), end.alias("end"), _let(near, score).alias("score"), ok)

    steps = F.zip_with(both["parts"], both["values"], lambda p, v: F.length(p) + F.coalesce(F.length(v), F.lit(0)))
    ends = _running(steps, lambda a, x: a + x)
    found = F.zip_with(both["values"], F.slice(ends, 1, F.size(both["values"])), described)
    sure = F.filter(found, lambda x: x["ok"] & ((no < len(BASE)) | (x["score"] >= LEAST)))
    return F.transform(sure, lambda x: F.struct(*(x[c].alias(c) for c in ("start", "no", "kind", "end", "score"))))


def spans(text: Column) -> Column:
    """Confirmed spans of a text, by start and kind: array of (start, no, kind, end, score).

    The kinds share one expression for what follows their matches: the driver analyses and rewrites a tree of it, not six.
    """
    text = F.coalesce(text, F.lit(""))
    kinds = F.filter(F.array(*(_found(no, text) for no in range(len(KINDS)))), lambda both: both.isNotNull())
    found = _let(_in_blocks(text), lambda blocks: F.array_sort(F.flatten(F.transform(kinds, lambda both: _placed(both, blocks)))))
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(_SPAN))


def _joined(found: Column, *more: str) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", *(x[c].cast("string") for c in ("kind", "start", "end", *more)))), ",")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, and the spans with their scores, of every row."""
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda x: x["no"] < len(BASE))
    of_kind = lambda kind: F.filter("found", lambda x: x["kind"] == kind)
    counts = (F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in BASE)
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), _joined(F.col("found"), "score").alias("scores"))


def masked_text(text: Column) -> Column:
    """``text`` with its spans replaced by their kinds in brackets; what several spans cover gets the first one's kind."""

    def masked(both: Column) -> Column:
        found, blocks = both["found"], both["blocks"]

        def pieces(covered: Column) -> Column:
            before = F.slice(F.concat(F.array(F.lit(0)), covered), 1, F.size(found))
            shown = F.zip_with(found, before, lambda x, at: F.when(x["start"] >= at, F.concat(_stretch(blocks, at, x["start"] - at), F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise(""))
            end = F.element_at(covered, -1)
            return F.concat(F.array_join(shown, ""), _stretch(blocks, end, F.length(text) - end))

        return _let(_running(F.transform(found, lambda x: x["end"]), lambda a, x: F.greatest(a, x)), pieces)

    shown = _let(spans(text), lambda found: F.when(F.size(found) > 0, _let(F.struct(found.alias("found"), _in_blocks(text).alias("blocks")), masked)).otherwise(text))
    return F.when(text.isNotNull(), shown)


def masked(documents: DataFrame) -> DataFrame:
    """The documents with the spans of each text masked; n_chars follows the text."""
    out = documents.withColumn("text", masked_text(F.col("text")))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")).cast(documents.schema["n_chars"].dataType))
    return out
