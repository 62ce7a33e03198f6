"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Only built-in functions: a document's spans are found in its own row, without a shuffle and without
Python. A match's place is the length of what ``split`` leaves before it. All patterns are written so
that a failed attempt is never repeated inside the same run of characters, which keeps the search linear
in the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import as_row, whole_text

NEAR = 48  # code points of context on each side of a span
NEIGHBOURS = 12  # matches that can lie in the context: the shortest have four code points
THRESHOLD = 0.5


@dataclass(frozen=True)
class Kind:
    """``score`` without context; ``words``, one of them nearby adds ``bonus``; ``hint`` must be in the text at all."""

    name: str
    pattern: str
    score: float
    words: tuple[str, ...]
    bonus: float = 0.3
    hint: str | None = None


# The first four are the base kinds, always reported when valid. \G lets a match follow the one before it.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, ("mail", "contact", "write"), hint="@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.7, ("ip", "host", "server", "address"), hint="."),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?){11}[0-9])[0-9]++(?:[\x20-][0-9]++)*+", 0.8, ("card", "visa", "credit", "karte", "carte", "tarjeta")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, ("phone", "tel", "call", "mobile", "fax"), hint="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", 0.9, ("iban", "account", "bank", "konto", "compte", "cuenta")),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, ("ssn", "social security", "tax id"), hint="-"),
    Kind("local_phone", r"(?<![0-9+.()\x20-])\(?0[0-9]{2,4}\)?[\x20/-][0-9]{3,4}(?:[\x20-][0-9]{2,4}){1,2}(?![0-9-])", 0.3, ("phone", "tel", "call", "mobile", "fax")),
)
BASE = ("email", "ip", "card", "phone")


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The Luhn checksum of a string of digits."""
    places = F.split(F.reverse(number), "")
    doubled = F.transform(
        places, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(account: Column) -> Column:
    """The ISO 7064 check of an IBAN without spaces: letters count 10 to 35, the rest modulo 97 is 1."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda rest, c: (rest * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (p == "") | (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        number = digits(match)
        return F.length(number).between(12, 19) & luhn(number)
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        account = F.replace(match, F.lit(" "), F.lit(""))
        return F.length(account).between(15, 34) & mod97(account)
    if kind == "ssn":
        return ~match.rlike("^(000|666|9)|-00-|-0000$")
    if kind == "local_phone":
        return F.length(digits(match)).between(7, 12)
    return F.lit(True)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def running(sizes: Column) -> Column:
    """Running sums of an array: steps of doubling width, so that the work is the length times its logarithm."""
    steps = F.slice(F.array(*[F.lit(1 << k) for k in range(31)]), F.lit(1), F.ceil(F.log2(F.greatest(F.size(sizes), F.lit(1)))).cast("int"))
    return F.aggregate(steps, sizes, lambda sums, step: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - step), F.lit(0))))


def proposals(text: Column, kind: Kind) -> Column:
    """Array of the leftmost non-overlapping matches, one element more than there are, which has no match.

    (gap, size, match, tail, head): the lengths of the text before the match and of the match, the match, and the end and the
    beginning of that text before, as long as context can be.
    """
    gaps = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    near = F.lit(NEAR)
    return F.zip_with(
        gaps, matches,
        lambda g, m: F.struct(
            F.length(g).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("size"), m.alias("match"), F.right(g, near).alias("tail"), F.left(g, near).alias("head")
        ),
    )


def around(items: Column, at: Column) -> Column:
    """The ``NEAR`` code points before and after the match number ``at``, from the matches and gaps next to it."""
    first, near = F.greatest(at - NEIGHBOURS, F.lit(0)), F.lit(NEAR)
    before = F.transform(F.slice(items, first + 1, at - first), lambda x: F.concat(x["tail"], F.right(x["match"], near)))
    after = F.transform(F.slice(items, at + 2, NEIGHBOURS + 1), lambda x: F.concat(x["head"], F.coalesce(F.left(x["match"], near), F.lit(""))))
    return F.concat(F.right(F.concat(F.concat_ws("", before), items[at]["tail"]), near), F.lit(" "), F.left(F.concat_ws("", after), near))


def spans_of(text: Column, kind: Kind) -> Column:
    """Array of (start, order, end, kind, score) of the valid matches of one kind."""
    order = [k.name for k in KINDS].index(kind.name)
    words = rf"(?i)(?<![\p{{L}}])({'|'.join(kind.words)})"

    def scored(items: Column, ends: Column) -> Column:
        held = F.transform(items, lambda x, i: F.struct(i.alias("at"), x["match"].alias("match")))
        held = F.filter(held, lambda s: s["match"].isNotNull() & valid(kind.name, s["match"]))

        def span(s: Column) -> Column:
            end = F.get(ends, s["at"])
            bonus = F.when(around(items, s["at"]).rlike(words), kind.bonus).otherwise(0.0)
            return F.struct(
                (end - F.length(s["match"])).alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind.name).alias("kind"), F.least(F.lit(kind.score) + bonus, F.lit(1.0)).alias("score")
            )

        return F.transform(held, span)

    found = bound(proposals(text, kind), lambda items: bound(running(F.transform(items, lambda x: x["gap"] + x["size"])), lambda ends: scored(items, ends)))
    some = text.contains(kind.hint) if kind.hint else F.lit(True)
    found = F.when(some & text.rlike(kind.pattern), found).otherwise(F.array().cast("array<struct<start:int,order:int,end:int,kind:string,score:double>>"))
    return found if kind.name in BASE else F.filter(found, lambda s: s["score"] >= THRESHOLD)


def find_spans(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``spans``: array of (start, order, end, kind, score) by start, then kind.

    Places are code points from 0, the end exclusive. Valid matches of the base kinds are always in; other
    kinds need a score of ``THRESHOLD``, which for weak patterns means a context word within ``NEAR`` code
    points. Spans of different kinds may overlap. A null or empty text has no spans; repeated rows are
    searched like any other; an empty table gives no row.
    """
    kept = docs.select(as_row(docs), whole_text(docs).alias("whole"))
    for kind in KINDS:
        kept = kept.withColumn(f"of_{kind.name}", spans_of(F.col("whole"), kind))
    return kept.select("row", F.array_sort(F.concat(*[F.col(f"of_{k.name}") for k in KINDS])).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of overlapping spans the first one counts."""
    found = find_spans(docs)

    def step(done: Column, s: Column) -> Column:
        free = s["start"] >= done["at"]
        piece = F.concat(done["out"], F.substr(F.col("row.text"), done["at"] + 1, s["start"] - done["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(free, s["end"]).otherwise(done["at"]).alias("at"), F.when(free, piece).otherwise(done["out"]).alias("out"))

    masked = F.aggregate(
        F.col("spans"), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda done: F.concat(done["out"], F.substr(F.col("row.text"), done["at"] + 1, F.length("row.text"))),
    )
    text = F.when(F.size("spans") > 0, masked).otherwise(F.col("row.text"))
    return found.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def span_report(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, base_sha256 and spans (see ``find_spans``)."""
    found = find_spans(docs)

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(listed(of(*BASE)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
