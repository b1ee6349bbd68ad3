"""Personal data in texts: patterns propose spans, checksums confirm them, context decides.

Everything is built from column functions inside the row of the document. A span's score is
its kind's prior, raised by a checksum that holds and by telling words shortly before it, and
lowered by a checksum that fails. Base kinds (email, ip, card, phone) are kept by their
validators alone; further kinds need a score of ``THRESHOLD``.

Patterns begin only where a run of their letters begins (or the last match ended) and never
give letters back, so a text of any length is read once; they match what the plain patterns
in the comments match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
#: Characters before a span in which context words count.
CONTEXT = 40


def _word(words: str) -> str:
    return f"(?i)(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"


def _matching(pattern: str) -> Callable[[Column], Column]:
    return lambda match: match.rlike(pattern)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits of the match pass Luhn's check."""
    numbers = F.split(F.reverse(digits(match)), "")
    weighed = F.transform(
        numbers,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))
        ),
    )
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod_97(match: Column) -> Column:
    """Whether an account number's check digits hold: the first four characters moved to the
    end, letters read as 10 to 35, the number leaves 1."""
    code = F.upper(F.regexp_replace(match, " ", ""))
    turned = F.concat(F.substr(code, F.lit(5)), F.substring(code, 1, 4))
    value = lambda c: F.conv(c, 36, 10).cast("int")
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda total, c: (total * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97,
    )
    return rest == 1


def card(match: Column) -> Column:
    return F.length(digits(match)).between(14, 19) & luhn(match)


def phone(match: Column) -> Column:
    return F.length(digits(match)).between(10, 15)


def octets(match: Column) -> Column:
    part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}(\.{part}){{3}}$")


@dataclass(frozen=True)
class Kind:
    """``hint`` is a cheap test that every text with a match passes."""

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column] | None = None
    prior: float = 0.5
    checked: float = 0.4
    context: str | None = None
    near: float = 0.4
    base: bool = False


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda text: F.contains(text, F.lit("@")),
        prior=0.9,
        base=True,
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _matching(r"[0-9]\.[0-9]"),
        octets,
        context=_word("ip|host|address|server|from"),
        base=True,
    ),
    # [0-9]([\x20-]?[0-9])+
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        _matching(r"[0-9][\x20-]?[0-9]"),
        card,
        context=_word("card|visa|credit|debit|payment"),
        base=True,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        _matching(r"\+[0-9]"),
        phone,
        prior=0.6,
        checked=0.2,
        context=_word("tel|phone|call|fax|mobile"),
        base=True,
    ),
    # compact, or in groups of four
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)",
        _matching(r"[A-Z]{2}[0-9]{2}"),
        mod_97,
        prior=0.3,
        context=_word("iban|account|bank|konto|cuenta|compte"),
        near=0.2,
    ),
    # a run of digits and hyphens is three, two and four digits
    Kind(
        "ssn",
        r"[0-9-]+",
        _matching(r"[0-9]-[0-9]{2}-[0-9]"),
        lambda match: match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
        & ~match.rlike("^000|^666|^9|-00-|-0000$"),
        prior=0.2,
        checked=0.1,
        context=_word("ssn|social|security|insurance"),
    ),
    # a letter and a digit among 16 or more, after a word that announces a secret
    Kind(
        "secret",
        r"[A-Za-z0-9+/_-]{16,}",
        _matching(r"(?i)password|passwd|secret|token|api[_ -]?key"),
        lambda match: match.rlike("[0-9]") & match.rlike("[A-Za-z]"),
        prior=0.1,
        checked=0.2,
        context="(?i)(?:password|passwd|secret|token|api[_ -]?key)[\"']? *[:=] *[\"']?$",
    ),
)
BASE = tuple(kind.name for kind in KINDS if kind.base)
SPAN = "struct<start:int,kind:int,end:int,score:double>"


def score(kind: Kind, match: Column, before: Column) -> Column:
    total = F.lit(kind.prior)
    if kind.valid is not None:
        total = total + F.when(kind.valid(match), kind.checked).otherwise(-kind.checked)
    if kind.context is not None:
        total = total + F.when(before.rlike(kind.context), kind.near).otherwise(0.0)
    return F.least(F.lit(1.0), total)


def kind_spans(text: Column, kind: Kind) -> Column:
    """The spans of one kind, as code points: what lies between matches tells where they are."""
    number = next(i for i, other in enumerate(KINDS) if other.name == kind.name)

    def placed(parts: Column) -> Column:
        """A running place and the spans so far, over matches and the gaps before them."""
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

        def add(state: Column, match: Column, gap: Column) -> Column:
            begin = state["at"] + F.length(gap)
            end = begin + F.length(match)
            before = F.substring(gap, -CONTEXT, CONTEXT)
            span = F.struct(
                begin.alias("start"),
                F.lit(number).alias("kind"),
                end.alias("end"),
                score(kind, match, before).alias("score"),
            )
            good = span["score"] >= THRESHOLD
            if kind.base:
                good = kind.valid(match) if kind.valid is not None else F.lit(True)
            spans = F.when(good, F.array_append(state["spans"], span)).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        pairs = F.arrays_zip(
            parts["found"].alias("match"),
            F.slice(parts["gaps"], F.lit(1), F.size(parts["found"])).alias("gap"),
        )
        return F.aggregate(
            pairs, start, lambda state, p: add(state, p["match"], p["gap"])
        )["spans"]

    parts = F.struct(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"),
        F.split(text, kind.pattern, -1).alias("gaps"),
    )
    # the one-element array has both lists made once for each row
    spans = F.transform(F.array(parts), placed)[0]
    return F.when(kind.hint(text), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def find(documents: DataFrame) -> DataFrame:
    """All spans of each row's whole text: start, end (exclusive), kind and score, ordered by
    start and kind. NULL and empty texts have none; rows that repeat are reported one by one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = F.concat(*[kind_spans(text, kind) for kind in KINDS])
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    found = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.array_sort(spans).alias("found")
    )
    return found.select(
        "doc_id",
        F.transform(
            "found",
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.get(names, s["kind"]).alias("kind"),
                s["score"].alias("score"),
            ),
        ).alias("spans"),
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans in writing."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    kinds = F.transform("spans", lambda s: s["kind"])

    def count(name: str) -> Column:
        return F.size(F.filter(kinds, lambda kind: kind == name)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(name).alias(f"n_{name}") for name in BASE],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
