"""Secrets in texts, and parts of credentials that give each other meaning.

Patterns propose spans of three roles: identifiers (who), secrets (by what) and endpoints
(where). Base kinds (assign, access, hex) are reported as they are. The other kinds are weak: a
user name, a random-looking token or an address alone says nothing. An interval join finds
parts that lie within ``REACH`` code points of each other in the same scope, a run of lines
without a blank one; a weak span is reported only if a complementary part is among them:
a secret for an identifier or endpoint, an identifier or endpoint for a secret.

Everything is built from column functions. One pass over the texts leaves the lengths of the
matches and of the gaps between them; places, scopes and links are worked out on rows of
spans, so a text with very many of them takes time in proportion. Patterns read a text
once: possessive quantifiers never give back what could not be matched otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources import scratch

#: Code points between the parts of a credential, at most.
REACH = 200
IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"


def _always(match: Column) -> Column:
    return F.lit(True)


def _assigned(names: str, value: str) -> str:
    """A name in either case, perhaps in quotes, an equals sign or colon, and a value."""
    return rf"((?i:{names}))[\"']?+\x20*+[:=]\x20*+[\"']?+({value}++)"


@dataclass(frozen=True)
class Kind:
    """``hint`` is a pattern that every text with a match holds."""

    name: str
    role: str | None
    pattern: str
    hint: str
    valid: Callable[[Column], Column] = _always
    base: bool = False


_ASSIGN = _assigned("password|passwd|secret|token|api_?key", "[A-Za-z0-9+/_.=-]")
_USER = _assigned("username|user|login|account|client_?id|access_?key_?id", "[A-Za-z0-9@+_.-]")
_HOST = _assigned("hostname|host|endpoint|server", "[A-Za-z0-9:/_.-]")
_URL = r"(?:https?|ftp|ssh|s3|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9:/_.@?=&%+~-]++"

#: In the order in which spans that start together are written.
KINDS = (
    Kind(
        "assign", SECRET, _ASSIGN, "(?i)password|passwd|secret|token|api_?key",
        lambda match: F.length(F.regexp_extract(match, _ASSIGN, 2)) >= 6, base=True,
    ),
    # AKIA[A-Z0-9]+ of 20 characters or more: a run that is too short holds no longer one
    Kind("access", IDENTIFIER, "AKIA[A-Z0-9]{16,}+", "AKIA", base=True),
    # [0-9a-f]+ of 24 characters or more
    Kind("hex", SECRET, "[0-9a-f]{24,}+", "[0-9a-f]{24}", base=True),
    Kind(
        "user", IDENTIFIER, _USER, "(?i)user|login|account|client_?id|access_?key_?id",
        lambda match: F.length(F.regexp_extract(match, _USER, 2)) >= 3,
    ),
    # a token of upper and lower case letters and digits
    Kind(
        "blob", SECRET, "[A-Za-z0-9+/_=-]{16,}+", "[A-Za-z0-9+/_=-]{16}",
        lambda match: match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]"),
    ),
    Kind("url", ENDPOINT, _URL, "://"),
    Kind(
        "host", ENDPOINT, _HOST, "(?i)host|endpoint|server",
        lambda match: F.length(F.regexp_extract(match, _HOST, 2)) >= 3,
    ),
)
#: Ends a scope; no kind of its own.
BREAK = Kind("break", None, r"\n[\x20\t]*+\n", "\n")
BASE = tuple(kind.name for kind in KINDS if kind.base)
LENGTHS = "array<struct<k:int,gap:int,length:int,valid:boolean>>"


def _lengths(text: Column, kind: Kind) -> Column:
    """Per match: its number, the length of the gap before it, its own, and whether it counts."""
    parts = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("match"),
        F.split(text, kind.pattern, -1).alias("gap"),
    )
    found = F.transform(
        parts,
        lambda p, k: F.struct(
            k.alias("k"),
            F.length(p["gap"]).alias("gap"),
            F.length(p["match"]).alias("length"),
            F.coalesce(kind.valid(p["match"]), F.lit(False)).alias("valid"),
        ),
    )
    # what follows the last match is a gap without one
    found = F.filter(found, lambda p: p["length"].isNotNull())
    return F.when(text.rlike(kind.hint), found).otherwise(F.array().cast(LENGTHS))


def _matches(documents: DataFrame) -> DataFrame:
    """A row per document with its matches' lengths by kind, as a written table: the numbers
    of the rows hold for all that is read from it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[_lengths(text, kind).alias(kind.name) for kind in KINDS],
        F.when(
            text.rlike("|".join(f"(?:{k.hint})" for k in KINDS if not k.base)),
            _lengths(text, BREAK),
        ).alias(BREAK.name),
    )
    weak = [F.exists(kind.name, lambda p: p["valid"]) for kind in KINDS if not kind.base]
    several = weak[0]
    for other in weak[1:]:
        several = several | other
    found = found.withColumn("weak", several).withColumn(
        BREAK.name, F.when(F.col("weak"), F.col(BREAK.name))
    )
    numbered = found.withColumn("row", F.monotonically_increasing_id())
    return scratch.written(numbered, "secret-matches")


def _placed(matches: DataFrame) -> DataFrame:
    """A row per valid match: row, kind, start and end, and whether the text has weak spans."""
    every = None
    for number, kind in enumerate((*KINDS, BREAK)):
        own = matches.select(
            "row", F.col("weak"), F.lit(number).alias("kind"), F.explode(kind.name).alias("m")
        )
        every = own if every is None else every.unionAll(own)
    so_far = Window.partitionBy("row", "kind").orderBy("m.k")
    end = F.sum(F.col("m.gap") + F.col("m.length")).over(so_far)
    return (
        every.withColumn("end", end)
        .filter("m.valid")
        .select("row", "weak", "kind", (F.col("end") - F.col("m.length")).alias("start"), "end")
    )


def _is(kind: str) -> Column:
    return F.col("kind") == next(i for i, k in enumerate((*KINDS, BREAK)) if k.name == kind)


def _parts(spans: DataFrame) -> DataFrame:
    """The spans of texts with weak ones, with scope and role: a random-looking token that
    touches another part is no part of its own."""
    along = Window.partitionBy("row").orderBy("start", "kind")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    after = along.rowsBetween(1, Window.unboundedFollowing)
    other = ~_is("blob") & ~_is("break")
    roles = F.array(*[F.lit(kind.role) for kind in KINDS])
    return (
        spans.filter("weak")
        .withColumn("scope", F.count(F.when(_is("break"), 1)).over(along))
        .withColumn("reached", F.max(F.when(other, F.col("end"))).over(before))
        .withColumn("next", F.min(F.when(other, F.col("start"))).over(after))
        .filter(~_is("break"))
        .filter(
            ~_is("blob")
            | (
                (F.coalesce("reached", F.lit(0)) <= F.col("start"))
                & (F.coalesce("next", F.col("end")) >= F.col("end"))
            )
        )
        .select("row", "scope", "kind", "start", "end", F.get(roles, F.col("kind")).alias("role"))
    )


def _links(parts: DataFrame, reach: int) -> DataFrame:
    """Each part with its nearest complementary one, if it has any: an interval join on places
    cut into bins of the reach. A bin holds no more parts than characters."""

    def bins(first: Column, last: Column) -> Column:
        low = F.floor(F.greatest(first, F.lit(0)) / reach)
        return F.explode(F.sequence(low, F.floor(last / reach)))

    left = parts.withColumn("bin", bins(F.col("start") - reach, F.col("end") + reach))
    right = parts.select(
        "row", "scope", F.col("kind").alias("p_kind"), F.col("start").alias("p_start"),
        F.col("end").alias("p_end"), F.col("role").alias("p_role"),
        bins(F.col("start"), F.col("end")).alias("bin"),
    )
    distance = F.greatest(
        F.lit(0), F.col("p_start") - F.col("end"), F.col("start") - F.col("p_end")
    )
    met = left.join(right, ["row", "scope", "bin"]).filter(
        ((F.col("role") == SECRET) != (F.col("p_role") == SECRET)) & (distance <= reach)
    )
    nearest = F.min(F.struct(distance.alias("distance"), "p_start", "p_kind", "p_end"))
    return met.groupBy("row", "kind", "start", "end").agg(nearest.alias("partner"))


def find(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """Per row: doc_id and its spans in order of start, then kind: start, end (exclusive), kind,
    role, and of the nearest complementary part, if any, the kind, start and end.

    NULL and empty texts have none. Rows that repeat are reported one by one. Only base kinds
    are reported without a complementary part; a text without weak spans links nothing.
    """
    matches = _matches(documents)
    spans = scratch.written(_placed(matches), "secret-spans")
    parts = scratch.written(_parts(spans), "credential-parts")
    linked = _links(parts, reach)
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    roles = F.array(*[F.lit(kind.role) for kind in KINDS])
    base = F.col("kind") < len(BASE)
    nobody = F.lit(None).cast("struct<distance:bigint,p_start:bigint,p_kind:int,p_end:bigint>")
    # the base spans without the partners that some of them have, and all spans with one
    reported = (
        spans.filter(base)
        .select("row", "kind", "start", "end", nobody.alias("partner"))
        .unionByName(linked)
        .groupBy("row", "kind", "start", "end")
        .agg(F.max("partner").alias("partner"))
    )
    span = F.struct(
        F.col("start"),
        F.col("kind").alias("number"),
        F.col("end"),
        F.get(names, F.col("kind")).alias("kind"),
        F.get(roles, F.col("kind")).alias("role"),
        F.get(names, F.col("partner.p_kind")).alias("partner"),
        F.col("partner.p_start").alias("partner_start"),
        F.col("partner.p_end").alias("partner_end"),
    )
    of_row = reported.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast(of_row.schema["spans"].dataType)
    return (
        matches.select("row", "doc_id")
        .join(of_row, "row", "left")
        .select("doc_id", F.coalesce("spans", none).alias("spans"))
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

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(name).alias(f"n_{name}") for name in BASE],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
