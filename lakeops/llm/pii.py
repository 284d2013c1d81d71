"""Personal data: patterns propose, checksums confirm, context words adjust.

Each kind has a pattern that proposes spans, an optional check (part limits,
digit counts, Luhn, mod 97 on every length) and a starting score.  Words of the kind within
``REACH`` code points before or after the span raise the score.  Four base kinds (email,
ip, card, phone) are kept whenever their check holds; the kinds added by the
method are kept from ``THRESHOLD`` on.

The patterns use possessive loops and start only where the run of characters
starts (or right after a match), so a long run is walked once.

Defined results: a null text is empty and has no spans; spans of different kinds
may overlap and are all reported; redaction replaces the union of overlapping
spans by one mark, that of the span that starts first (then by order of kinds);
null stays null under redaction; repeated rows are treated alike; other columns
are passed on untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.exprs import SPAN, let, running, spans

REACH = 40
THRESHOLD = 0.6


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a text without this pattern has no span of the kind
    valid: Callable[[Column], Column] | None
    score: float
    context: str
    base: bool = False
    extent: Callable[[Column, Column], Column] | None = None  # from proposed to confirmed spans


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, less 9 above 9; the sum ends in 0."""

    def one(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, F.lit(9)).otherwise(F.lit(0)))

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + one(i))
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """First four characters moved to the end, letters as 10 to 35: the number leaves 1 over 97."""
    turned = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        value = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return (rest * F.when(letter, F.lit(100)).otherwise(F.lit(10)) + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _valid_ip(m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _valid_card(m: Column) -> Column:
    return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))


def _valid_phone(m: Column) -> Column:
    return F.length(_digits(m)).between(9, 15)


# The lengths that countries have given their account numbers.
IBAN_LENGTHS = {
    code: int(part[:2])
    for part in (
        "15NO 16BE 18DKFKFOFINLSD 19MKSI 20ATBAEEKZLTLUMNXK 21CHHRLILV 22BABGBHCRDEGBGEIEMERSVA 23AEGIILIQOMSOTL"
        " 24ADCZESMDPKROSASESKTNVG 25LYPTST 26ISTR 27BIDJFRGRITMCMRSM 28ALAZBYCYDOGTHNHULBNIPLSV 29BREGPSQAUA"
        " 30JOKWMUYE 31MTSC 32LC 33RU"
    ).split()
    for code in (part[i : i + 2] for i in range(2, len(part), 2))
}
IBAN_GROUPS = "^[A-Z]{2}[0-9]{2}[A-Z0-9]*+(?![a-z])(?: [A-Z0-9]++(?![a-z]))*+"


def _ibans(text: Column, heads: Column) -> Column:
    """The account numbers that start at the heads.

    What follows a head may be words or numbers of the text, so every stretch of 15 to
    34 characters that ends with a group is tried: the country's length first, then
    the longest.  A head inside an account number before it starts none.
    """
    lengths = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))

    def whole(x: Column) -> Column:
        # 34 characters in groups stay below 68 with their spaces, so a group that this cuts is never taken
        groups = F.split(F.regexp_extract(F.substring(text, x["s"] + 1, F.lit(68)), IBAN_GROUPS, 0), " ")

        def ends(g: Column) -> Column:
            tried = F.transform(
                F.sequence(F.lit(1), F.size(g)),
                lambda k: F.struct(
                    F.array_join(F.slice(g, F.lit(1), k), "").alias("code"),
                    F.length(F.array_join(F.slice(g, F.lit(1), k), " ")).alias("width"),
                ),
            )
            right = F.filter(
                tried,
                lambda c: F.when(F.length(c["code"]).between(15, 34), mod97(c["code"])).otherwise(F.lit(False)),
            )
            country = F.try_element_at(lengths, F.substring(x["m"], F.lit(1), F.lit(2)))
            order = F.transform(
                right,
                lambda c: F.struct(
                    (~F.length(c["code"]).eqNullSafe(country)).alias("other"), (-c["width"]).alias("less"),
                ),
            )
            return F.array_min(order)["less"]

        return F.struct(x["s"].alias("s"), (x["s"] - let(groups, ends)).alias("e"), x["m"].alias("m"))

    def apart(at: Column) -> Column:
        return F.aggregate(
            at, F.array().cast(SPAN),
            lambda done, x: F.when(
                (F.size(done) > 0) & (x["s"] < F.try_element_at(done, F.lit(-1))["e"]), done
            ).otherwise(F.array_append(done, x)),
        )

    def settled(at: Column) -> Column:
        nested = F.exists(
            F.sequence(F.lit(1), F.size(at)), lambda i: F.try_element_at(at, i + 1)["s"] < at[i - 1]["e"]
        )
        return F.when(F.size(at) < 2, at).when(nested, apart(at)).otherwise(at)

    return let(F.filter(F.transform(heads, whole), lambda x: x["e"].isNotNull()), settled)


def _run(chars: str) -> str:
    """Where a run of these characters starts, or right after the match before."""
    return rf"(?:\G|(?<![{chars}]))"


_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    Kind(
        "email",
        rf"{_run(_LOCAL)}[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", None, 0.9, r"mail|contact|write to", base=True,
    ),
    Kind(
        "ip",
        rf"{_run('0-9')}[0-9]++(?:\.[0-9]++){{3}}",
        r"[0-9]\.[0-9]", _valid_ip, 0.6, r"\bip\b|address|server|host", base=True,
    ),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", "[0-9]", _valid_card, 0.7, r"card|visa|master|amex|credit|debit", base=True),
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", _valid_phone, 0.7,
        r"phone|\btel\b|call|mobile|fax|contact", base=True,
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]){11})",
        "[A-Z]{2}[0-9]{2}", None, 0.8, r"iban|account|bank|konto|compte|cuenta", extent=_ibans,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "[0-9]-[0-9]{2}-[0-9]", None, 0.4, r"\bssn\b|social security|tax id",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+)-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        "[0-9][ .-][0-9]{4}", None, 0.4, r"phone|\btel\b|call|mobile|fax|cell",
    ),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.base)
FOUND = "array<struct<s:int,rank:int,e:int,kind:string,score:double>>"


def _score(text: Column, kind: Kind, at: Column) -> Column:
    """Starting score, raised by 0.3 by a context word shortly before or after the span; at most 1."""
    left = F.greatest(at["s"] - REACH, F.lit(0))
    before = F.substring(text, left + 1, at["s"] - left)
    after = F.substring(text, at["e"] + 1, F.lit(REACH))
    near = F.lower(before).rlike(kind.context) | F.lower(after).rlike(kind.context)
    return F.least(F.lit(kind.score) + F.when(near, F.lit(0.3)).otherwise(F.lit(0.0)), F.lit(1.0))


def found(text: Column, threshold: float = THRESHOLD) -> Column:
    """All spans of a text, sorted by start, then kind as listed, then end."""

    def of_kind(t: Column, rank: int, kind: Kind) -> Column:
        at = spans(t, kind.pattern)
        if kind.valid is not None:
            at = F.filter(at, lambda x: kind.valid(x["m"]))
        if kind.extent is not None:
            at = kind.extent(t, at)
        scored = F.transform(
            at,
            lambda x: F.struct(
                x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e"), F.lit(kind.name).alias("kind"),
                _score(t, kind, x).alias("score"),
            ),
        )
        kept = scored if kind.base else F.filter(scored, lambda x: x["score"] >= threshold)
        return F.when(t.rlike(kind.hint), kept).otherwise(F.array().cast(FOUND))

    def in_text(t: Column) -> Column:
        return F.sort_array(F.concat(*(of_kind(t, rank, kind) for rank, kind in enumerate(KINDS))))

    return let(F.coalesce(text, F.lit("")), in_text)


def joined(found_spans: Column) -> Column:
    """``kind:start:end`` with commas between."""
    return F.array_join(
        F.transform(found_spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def personal_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id`` and ``found``, the sorted array of ``(s, rank, e, kind, score)``."""
    return docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col), threshold).alias("found"))


def span_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    base = F.filter("found", lambda x: x["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return personal_spans(docs, id_col, text_col, threshold).select(
        "doc_id", *(count(k) for k in BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def redacted(text: Column, threshold: float = THRESHOLD) -> Column:
    """The text with each stretch of personal data replaced by ``<KIND>``."""

    def cut(at: Column) -> Column:
        def with_reach(reach: Column) -> Column:
            # reach[i] is the furthest end among the first i + 1 spans
            last = F.size(at) - 1
            opens = F.filter(at, lambda x, i: F.when(i > 0, x["s"] >= reach[i - 1]).otherwise(F.lit(True)))
            ends = F.filter(reach, lambda r, i: F.when(i < last, at[i + 1]["s"] >= r).otherwise(F.lit(True)))

            def stitch(pieces: Column) -> Column:
                o, e = pieces["o"], pieces["e"]
                after = F.transform(
                    o,
                    lambda x, i: F.concat(
                        F.lit("<"), F.upper(x["kind"]), F.lit(">"),
                        F.substring(
                            text, e[i] + 1,
                            F.when(i < F.size(o) - 1, F.try_element_at(o, i + 2)["s"]).otherwise(F.length(text)) - e[i],
                        ),
                    ),
                )
                return F.concat(F.substring(text, F.lit(1), o[0]["s"]), F.array_join(after, ""))

            return let(F.struct(opens.alias("o"), ends.alias("e")), stitch)

        reach = running(F.transform(at, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
        return F.when(F.size(at) == 0, text).otherwise(let(reach, with_reach))

    return F.when(text.isNotNull(), let(found(text, threshold), cut))


def redact(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows with personal data replaced in the text column."""
    return docs.withColumn(text_col, redacted(docs[text_col], threshold))
