"""Personal data in texts: patterns propose spans, checksums confirm them, context scores them.

DataFrame functions only. Every kind has a pattern; its matches are the leftmost ones
that do not overlap, found with one split and one extraction of the whole text, so their
places follow from the lengths of the pieces. A match that a kind's validator rejects is
dropped and not tried again. The score of a span is the kind's own, which a context word near
the span raises; where there is none, a word that speaks against the kind (a version number
is no address, an order number no card) lowers it. Near are the ``CONTEXT_CHARS`` code points
on each side, whatever else matches in them.

The four base kinds (email, ip, card, phone) stay at any score: those below ``MIN_SCORE`` are
doubtful, and callers can leave them out by the score. Spans of other kinds go below
it. An IBAN needs the mod-97 checksum and no word against it, or a context word;
social security numbers and phone numbers without a country code need a context word.

The patterns match possessively and only at the start of a run of their characters, or
where the last match ended: the same matches as without, but linear on any text and
without recursion in Java's matcher.

A null text is treated as empty: no spans. Starts and ends count code points, the end is
exclusive. Equal rows give the same spans each; spans of different kinds may overlap. Very
long texts are read whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clicktide.llm.common import computed_once

MIN_SCORE = 0.5
CONTEXT_CHARS = 40
# Matches whose places are summed together, so that a text with very many stays linear.
GROUP = 256

_SPANS = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
_FINDINGS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digit string passes the Luhn check."""
    places = F.split(F.reverse(digits), "")

    def weighed(digit: Column, place: Column) -> Column:
        twice = digit.cast("int") * 2
        return F.when(place % 2 == 0, digit.cast("int")).otherwise(
            F.when(twice > 9, twice - 9).otherwise(twice)
        )

    total = F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether the IBAN (upper case, without blanks) leaves 1 when divided by 97."""
    moved = F.split(F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4))), "")

    def fed(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise(
            (rest * 10 + code - 48) % 97
        )

    return F.aggregate(moved, F.lit(0), fed) == 1


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(13, 19) & luhn(digits)


def _ip(value: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _phone(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def _iban(value: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")
    return F.length(plain).between(15, 34) & mod97(plain)


def _ssn(value: Column) -> Column:
    """The whole run of digits and hyphens is a number that can be issued."""
    return value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")


def _local_phone(value: Column) -> Column:
    """The whole run of digit groups is area, exchange and line, without a country code."""
    return value.rlike(r"^(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}$")


def _always(value: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a pattern without which there is no match; cheap to look for
    valid: object
    score: float  # of a confirmed match
    context: str  # words that raise the score
    against: str  # words that lower it where no context word is near
    raise_by: float = 0.2
    lower_by: float = 0.25

    @property
    def raised(self) -> float:
        return round(self.score + self.raise_by, 3)

    @property
    def lowered(self) -> float:
        return round(self.score - self.lower_by, 3)

    @property
    def least(self) -> float:
        """Spans of a lower score go."""
        return 0.0 if self.name in BASE_KINDS else MIN_SCORE


BASE_KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
_CALLED = r"\b(?:phone|tel|call|mobile|fax|whatsapp)\b"
_NUMBERED = r"\b(?:order|invoice|serial|part|item|isbn|imei|tracking|ticket|version)\b"
_VERSIONED = r"\b(?:version|release|build|firmware|driver|section|chapter|paragraph)\b"
KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", _always, 0.8, r"\b(?:e-?mail|mail|contact|write)\b",
        r"\b(?:package|commit|git|ssh|scp|npm)\b",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]", _ip, 0.6, r"\b(?:ip|host|server|address|login)\b", _VERSIONED,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        "[0-9]{2}|[0-9][ -][0-9]", _card, 0.7,
        r"\b(?:card|visa|mastercard|amex|credit|debit|payment)\b", _NUMBERED,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]", _phone, 0.6, _CALLED, _NUMBERED,
    ),
    Kind(
        "iban",
        r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
        "[A-Z]{2}[0-9]{2}", _iban, 0.7, r"\b(?:iban|account|bank|konto|cuenta|compte)\b",
        _NUMBERED,
    ),
    Kind(
        "ssn",
        "[0-9-]++",
        "[0-9]{3}-[0-9]{2}-", _ssn, 0.35, r"\b(?:ssn|social security|tax id)\b",
        _NUMBERED,
    ),
    Kind(
        "local_phone",
        r"[+(]?[0-9]++(?:[ ().-]{1,3}+[0-9]++)*+",
        "[0-9]{3}[ .-][0-9]{3}", _local_phone, 0.45, _CALLED, _NUMBERED,
    ),
)


def located(text: Column, pattern: str) -> Column:
    """The matches in order: start, end, value, and the text between each and the next ones,
    of which ``CONTEXT_CHARS`` at most."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def zipped(between: Column) -> Column:
        after = F.slice(between, F.lit(2), F.size(between))
        return F.arrays_zip(between.alias("before"), values.alias("value"), after.alias("after"))

    matches = computed_once(F.split(text, pattern, -1), zipped)

    def placed(state: Column, match: Column) -> Column:
        start = state["at"] + F.length(match["before"])
        end = start + F.length(match["value"])
        span = F.struct(
            start.alias("start"),
            end.alias("end"),
            match["value"].alias("value"),
            F.right(match["before"], F.lit(CONTEXT_CHARS)).alias("before"),
            F.left(match["after"], F.lit(CONTEXT_CHARS)).alias("after"),
        )
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(match["value"].isNull(), state["spans"])
            .otherwise(F.concat(state["spans"], F.array(span)))
            .cast(_SPANS)
            .alias("spans"),
        )

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def groups(all_matches: Column) -> Column:
        last = F.floor((F.size(all_matches) - 1) / GROUP).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda g: F.aggregate(F.slice(all_matches, g * GROUP + 1, GROUP), nothing, placed),
        )

    def shifted(state: Column, group: Column) -> Column:
        moved = F.transform(
            group["spans"],
            lambda s: s.withField("start", s["start"] + state["at"]).withField(
                "end", s["end"] + state["at"]
            ),
        )
        return F.struct(
            (state["at"] + group["at"]).alias("at"),
            F.concat(state["lists"], F.array(moved)).cast(f"array<{_SPANS}>").alias("lists"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("lists"))
    return F.flatten(computed_once(matches, lambda m: F.aggregate(groups(m), start, shifted)["lists"]))


def _near(spans: Column, span: Column) -> Column:
    """The text on both sides of a span, from the pieces and matches there.

    No match is empty, so as many matches as characters are enough on each side. Cutting
    it out of the whole text would read that from its start for every span.
    """
    nth, most = span["nth"], CONTEXT_CHARS
    earlier = F.slice(spans, F.greatest(nth - most, F.lit(0)) + 1, F.least(nth, F.lit(most)))
    before = F.transform(earlier, lambda s: F.concat(s["before"], F.right(s["value"], F.lit(most))))
    after = F.transform(
        F.slice(spans, nth + 2, most), lambda s: F.concat(F.left(s["value"], F.lit(most)), s["after"])
    )
    return F.concat_ws(
        " ",
        F.right(F.concat(F.array_join(before, ""), span["before"]), F.lit(most)),
        F.left(F.concat(span["after"], F.array_join(after, "")), F.lit(most)),
    )


def findings_of(text: Column, kind: Kind) -> Column:
    """The kind's confirmed spans with their scores, by start."""

    def scored(spans: Column, span: Column) -> Column:
        near = F.lower(_near(spans, span))
        score = F.when(near.rlike(kind.context), kind.raised).when(near.rlike(kind.against), kind.lowered)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            score.otherwise(kind.score).alias("score"),
        )

    def all_scored(spans: Column) -> Column:
        numbered = F.transform(spans, lambda span, nth: span.withField("nth", nth))
        confirmed = F.filter(numbered, lambda span: kind.valid(span["value"]))
        return F.transform(confirmed, lambda span: scored(spans, span))

    found = computed_once(located(text, kind.pattern), all_scored)
    kept = F.filter(found, lambda f: f["score"] >= kind.least)
    none = F.array().cast(_FINDINGS)
    return F.when(text.rlike(kind.hint), kept.cast(_FINDINGS)).otherwise(none)


def find_pii(texts: DataFrame, text: str = "text", into: str = "findings") -> DataFrame:
    """All columns and ``findings``: kind, start, end and score, by kind as listed, then start.

    ``into`` replaces a column of that name, if the table has one.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return texts.withColumn(into, F.concat(*(findings_of(whole, kind) for kind in KINDS)))


def span_list(findings: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ","
    )


def score_list(findings: Column) -> Column:
    """The scores in percent, in the order of ``span_list``, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.round(f["score"] * 100).cast("int").cast("string")), ",")


def masked(text: Column, findings: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans as one."""
    ordered = F.array_sort(
        F.transform(
            findings,
            lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"), f["kind"].alias("kind")),
        )
    )

    def replaced(state: Column, span: Column) -> Column:
        new = span["start"] >= state["at"]
        piece = F.concat(
            F.substr(text, state["at"] + 1, span["start"] - state["at"]),
            F.lit("["), F.upper(span["kind"]), F.lit("]"),
        )
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(new, F.concat(state["done"], piece)).otherwise(state["done"]).alias("done"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    rest = F.aggregate(
        ordered, start, replaced, lambda s: F.concat(s["done"], F.substr(text, s["at"] + 1))
    )
    return F.when(F.size(findings) > 0, rest).otherwise(text)
