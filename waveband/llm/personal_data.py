"""Personal data by pattern, checksum and context, in DataFrame functions only.

For each kind a regular expression proposes spans, leftmost and without overlap; a check
on the proposed text confirms or drops them; no part of a dropped match is tried again.
Each span gets a score: the kind's own, raised where a context word stands within
``window`` code points before it. Spans of the base kinds (email, ip, card, phone) always
stay; spans of the added kinds (IBAN, secret) stay if their score reaches ``least``.

The patterns here find what the plain ones in the contract find, without their backtracking:
a match can only begin at the start of a run of its first class or where the last match ended
(``\\G``), and possessive repeats are safe where the next part can't be in the class.

How positions come from built-in functions: the matches are marked with a control character
on both sides (the text's own ones are first turned into another control character, which no
pattern has), the marked text is split there, and running lengths give the offsets. Offsets
are in code points, ends exclusive. Running values are taken in blocks of the root of their number, so
n spans of one text cost n times that root at most, and a masked text is put together once from its parts.

Defined cases: null text is the empty text and has no spans; spans of different kinds may
overlap and are all listed, by start, then kind; rows are judged one by one, so repeated rows
and ids make no difference; a masked text replaces overlapping spans together, under the kind
of the first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waveband.llm.shared import fresh_name

_MARK, _OTHER = "\u0001", "\u0002"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without a match of this simple pattern has no match
    score: float
    context: str  # words that raise the score, in lower case
    base: bool = True


#: The kinds in the order in which they are listed.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", 0.9, "mail|contact|write|kontakt|correo|courriel",
    ),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, "ip|host|server|address|login"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", r"[0-9][ -]?[0-9]", 0.8, "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", 0.7, "phone|call|tel|mobile|fax|tél"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}", 0.9, "iban|account|konto|bank|cuenta|compte", False),
    Kind("secret", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,64}+(?![A-Za-z0-9+/_-])", r"[A-Za-z0-9+/_-]{32}", 0.3, "key|token|secret|password|passwd|bearer", False),
)
CONTEXT_SCORE = 0.4
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The sum by Luhn's rule is a multiple of ten: from the right, every second digit is doubled."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(F.filter(each, lambda d: d.isNotNull()), F.lit(0), lambda total, d: total + d) % 10 == 0


def _mod_97(value: Column) -> Column:
    """ISO 7064: the first four characters go to the end, letters count from 10, the number leaves 1."""
    plain = F.regexp_replace(value, " ", "")
    moved = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")
    code = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.filter(moved, lambda c: c != ""), F.lit(0), lambda r, c: (r * F.when(code(c) > 9, 100).otherwise(10) + code(c)) % 97)
    return rest == 1


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")) <= 3
        return F.forall(F.split(value, r"\."), lambda p: part(p) & (F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(value, " ", "")).between(15, 34) & _mod_97(value)
    if kind == "secret":
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each of the whole numbers the fold of those before it, from 0; block by block, as each step copies what it adds to."""
    def steps(block: Column, first: Column) -> Column:
        start = F.struct(first.alias("now"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            block, start, lambda s, v: F.struct(fold(s["now"], v).cast("int").alias("now"), F.array_append(s["out"], s["now"]).alias("out")), lambda s: s["out"])

    def blocked(v: Column) -> Column:
        root = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(v), root), lambda i: F.slice(v, i, root))

    def joined(blocks: Column) -> Column:
        zero = F.lit(0).cast("int")
        folded = F.transform(blocks, lambda block: F.aggregate(block, zero, lambda x, v: fold(x, v).cast("int")))
        return F.flatten(F.zip_with(blocks, steps(folded, zero), steps))

    return _let(values, lambda v: F.when(F.size(v) > 0, _let(blocked(v), joined)).otherwise(F.array().cast("array<int>")))


def _spans_of(kind: Kind, rank: int, text: Column, window: int, least: float) -> Column:
    """The kind's spans in a text without the mark."""
    marked = F.split(F.regexp_replace(text, kind.pattern, f"{_MARK}$0{_MARK}"), _MARK)
    empty = F.array().cast(SPAN)

    def span(parts: Column, starts: Column, i: Column) -> Column:
        near = F.lower(F.substring(parts[i - 1], -window, window)).rlike(rf"(?<![a-z])(?:{kind.context})")
        score = F.round(F.least(F.lit(1.0), F.lit(kind.score) + F.when(near, CONTEXT_SCORE).otherwise(0.0)), 3)
        made = F.struct(
            starts[i].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), (starts[i] + F.length(parts[i])).cast("int").alias("end"), score.alias("score"))
        return F.when(_confirmed(kind.name, parts[i]) & (F.lit(kind.base) | (score >= least)), made)

    def spans(parts: Column) -> Column:
        starts = _running(F.transform(parts, lambda part: F.length(part)), lambda at, size: at + size)
        each = _let(starts, lambda at: F.transform(F.sequence(F.lit(1), F.size(parts) - 1, F.lit(2)), lambda i: span(parts, at, i)))
        return F.when(F.size(parts) > 1, F.filter(each, lambda s: s.isNotNull()).cast(SPAN)).otherwise(empty)

    return F.when(text.rlike(kind.needs), _let(marked, spans)).otherwise(empty)


def with_spans(docs: DataFrame, name: str, text: str = "text", window: int = 40, least: float = 0.6) -> DataFrame:
    """``docs`` with a column of all spans, by start, then by kind in the order of :data:`KINDS`."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _MARK, _OTHER)
    found = [_spans_of(kind, rank, plain, window, least) for rank, kind in enumerate(KINDS)]
    return docs.withColumn(name, F.array_sort(F.concat(*found)))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", window: int = 40, least: float = 0.6) -> DataFrame:
    """Columns ``keep``, counts of the base kinds, the digest of their spans, all spans as text and all found with scores."""
    source = docs.select(text, *keep)
    name = fresh_name(source, "found")
    listed = with_spans(source, name, text, window, least)
    found = F.col(name)
    n_base = sum(k.base for k in KINDS)
    number = lambda rank: F.size(F.filter(found, lambda s: s["rank"] == rank)).cast("long")
    counts = [number(rank).alias(f"n_{k.name}") for rank, k in enumerate(KINDS) if k.base]
    base = F.filter(found, lambda s: s["rank"] < n_base)
    return listed.select(*keep, *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(found).alias("spans"))


def mask(docs: DataFrame, text: str = "text", length: str = "n_chars", window: int = 40, least: float = 0.6) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``length`` follows where it is a column."""
    name = fresh_name(docs, "found")
    listed = with_spans(docs, name, text, window, least)
    # the furthest end before each span; a span that starts behind it is the first of those that it overlaps with
    reached = _running(F.transform(name, lambda s: s["end"]), F.greatest)
    zipped = lambda at: F.transform(name, lambda s, k: F.struct(at[k].alias("at"), s["start"].alias("start"), s["kind"].alias("kind")))
    first = F.filter(_let(reached, zipped), lambda s: s["start"] >= s["at"])
    last = F.array_max(F.transform(name, lambda s: s["end"]))

    def put_together(chars: Column) -> Column:
        between = lambda a, n: F.array_join(F.slice(chars, a + 1, n), "")
        parts = F.transform(first, lambda s: F.concat(between(s["at"], s["start"] - s["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.concat(F.array_join(parts, ""), between(last, F.size(chars)))

    cut = _let(F.regexp_extract_all(F.col(text), F.lit("(?s)."), F.lit(0)), put_together)
    changed = F.size(name) > 0
    # a column of its own first: in one select, Spark would take the new text for the one that the lambdas read
    masked = fresh_name(listed, "masked")
    listed = listed.withColumn(masked, F.when(changed, cut).otherwise(F.col(text)))
    columns = {c: F.col(c) for c in docs.columns} | {text: F.col(masked).alias(text)}
    if length in docs.columns:
        kind = docs.schema[length].dataType
        columns[length] = F.when(changed, F.length(masked)).otherwise(F.col(length)).cast(kind).alias(length)
    return listed.select(*columns.values())
