"""Personal data by patterns, checksums and context, in DataFrame functions only.

Patterns propose spans; a part check, Luhn, mod-97 or a count of digits confirms
them; words just before or after a span raise its score. Positions come from the
gaps that splitting at a pattern leaves, so a text is read twice per kind that it
holds and once per kind that it does not. The patterns are written with
possessive repeats and anchored starts, so they take linear time and constant
stack on any text, and match as the plain ones in the comments do. Matches are
folded block by block, since an array that grows is copied with each step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters on either side of a span, up to the next one of its kind, that are searched for context words.
CONTEXT = 40
CONTEXT_BONUS = 0.3


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    # A sign without which a text holds nothing of the kind, or nothing.
    sign: str
    confidence: float
    context: str


_LOCAL = r"[A-Za-z0-9._%+-]"
# Characters of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK ST TN VG",
    25: "LY PT", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _spaced_iban(length: int, countries: str) -> str:
    """Groups of four, the last one shorter, of a number of known length that ends there."""
    groups, rest = divmod(length - 4, 4)
    last = rf"\x20[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20[A-Z0-9]{{4}}){{{groups}}}{last}(?![A-Z0-9])"


# Any of them, refused early where no number starts.
_SPACED = rf"(?=[A-Z]{{2}}[0-9]{{2}}\x20)(?:{'|'.join(_spaced_iban(n, c) for n, c in IBAN_LENGTHS.items())})"
# In the order in which spans are listed.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.7, "mail|contact|write"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.5, r"\bip\b|addr|host|server|login"),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.6, "card|visa|credit|payment"),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.5, "tel|phone|call|mobile|fax"),
    Kind(
        "iban",
        # [A-Z]{2}[0-9]{2}([A-Z0-9]{11,30}|(\x20[A-Z0-9]{4}){2,7}(\x20[A-Z0-9]{1,3})?), but a spaced number ends
        # where its country says, and none runs over the beginning of such a number.
        rf"{_SPACED}|[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?:\x20(?!{_SPACED})[A-Z0-9]{{4}}){{2,7}}"
        rf"(?:\x20(?!{_SPACED})[A-Z0-9]{{1,3}})?)",
        "",
        0.6,
        "iban|account|konto|bank",
    ),
)
BASE_KINDS = ("email", "ip", "card", "phone")
# A number of at most 255, and four of them.
_PART = r"0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])?"
_PARTS = rf"^(?:(?=[0-9]){_PART}(?![0-9])\.){{3}}(?=[0-9]){_PART}$"
SPAN = "struct<kind:string,start:int,stop:int,text:string,score:double>"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number with its country passes the mod-97 check."""
    plain = F.regexp_replace(account, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        value = F.ascii(c) - F.when(c.between("0", "9"), 48).otherwise(55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    signs = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(signs, F.lit(0), add) == 1


def _confirmed(kind: str, text: Column) -> Column:
    count = F.length(digits_of(text))
    if kind == "ip":
        return F.regexp_like(text, F.lit(_PARTS))
    if kind == "card":
        return F.when(count.between(16, 19), luhn(digits_of(text))).otherwise(False)
    if kind == "phone":
        return count.between(8, 15)
    if kind == "iban":
        return mod97(text)
    return F.lit(True)


# Items folded at a time; texts with many more take the square root of their number.
BLOCK = 64


def _folded(items: Column, begin: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """Folds items, each step giving the next state and items (of the SQL type ``kind``) to put out.

    Gives the last state, ``held``, and all that was put out, ``out``. Within a block, and then over
    blocks, the output grows by copies, so n items cost about n ** 1.5 in all
    rather than n ** 2.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(state: Column, item: Column) -> Column:
        after, out = step(state["held"], item)
        # A step is evaluated once although two fields are taken from it.
        made = F.array(F.struct(after.alias("held"), out.alias("out")))
        return F.transform(made, lambda m: F.struct(m["held"].alias("held"), F.concat(state["out"], m["out"]).alias("out")))[0]

    def block(state: Column, part: Column) -> Column:
        inner = F.array(F.aggregate(part, F.struct(state["held"].alias("held"), none.alias("out")), one))
        return F.transform(
            inner, lambda m: F.struct(m["held"].alias("held"), F.concat(state["out"], F.array(m["out"])).alias("out"))
        )[0]

    def whole(all_items: Column) -> Column:
        n = F.size(all_items)
        size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(n)).cast("int"))
        starts = F.when(n > 0, F.sequence(F.lit(1), n, size)).otherwise(F.array().cast("array<int>"))
        parts = F.transform(starts, lambda s: F.slice(all_items, s, size))
        nothing = F.struct(begin.alias("held"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        end = F.array(F.aggregate(parts, nothing, block))
        return F.transform(end, lambda e: F.struct(e["held"].alias("held"), F.flatten(e["out"]).alias("out")))[0]

    # What a function names is evaluated each time it is called, but for its own arguments.
    return F.transform(F.array(items), whole)[0]


def _spans(kind: Kind, gaps: Column, found: Column) -> Column:
    """Confirmed spans from the gaps around the matches and the matches themselves."""

    def add(at: Column, pair: Column) -> tuple[Column, Column]:
        begin = at + pair["before"]["n"]
        stop = begin + F.length(pair["text"])
        context = F.lit(kind.context)
        near = F.regexp_like(pair["before"]["tail"], context) | F.regexp_like(pair["after"]["head"], context)
        score = kind.confidence + F.when(near, CONTEXT_BONUS).otherwise(0.0)
        span = F.struct(
            F.lit(kind.name).alias("kind"),
            begin.alias("start"),
            stop.alias("stop"),
            pair["text"].alias("text"),
            score.alias("score"),
        ).cast(SPAN)
        more = F.when(_confirmed(kind.name, pair["text"]), F.array(span)).otherwise(F.array().cast(f"array<{SPAN}>"))
        return stop, more

    n = F.size(found)
    around = F.zip_with(F.slice(gaps, 1, n), F.slice(gaps, 2, n), lambda a, b: F.struct(a.alias("before"), b.alias("after")))
    pairs = F.zip_with(around, found, lambda g, t: F.struct(g["before"].alias("before"), g["after"].alias("after"), t.alias("text")))
    return _folded(pairs, F.lit(0), add, SPAN)["out"]


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "pii_spans") -> DataFrame:
    """Adds ``out``: all spans by kind, in the order of ``KINDS``, then by start.

    Starts and stops are code points, the stop exclusive. A null or empty text
    has none. Spans of different kinds may overlap; those of one kind do not. The
    score is the confidence in the kind, and more if a context word stands near.
    Repeated rows get the same spans. Other columns pass through, but for one
    that is named ``out`` itself.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    empty_gap = F.array().cast("array<struct<n:int,tail:string,head:string>>")
    gaps, found = {}, {}
    for kind in KINDS:
        cut = F.transform(
            F.split(text, kind.pattern, -1),
            lambda g: F.struct(
                F.length(g).alias("n"),
                F.lower(F.right(g, F.lit(CONTEXT))).alias("tail"),
                F.lower(F.left(g, F.lit(CONTEXT))).alias("head"),
            ),
        )
        gaps[f"_pii_gap_{kind.name}"] = F.when(F.contains(text, F.lit(kind.sign)), cut).otherwise(empty_gap) if kind.sign else cut
        holds = F.size(f"_pii_gap_{kind.name}") > 1
        matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        found[f"_pii_hit_{kind.name}"] = F.when(holds, matches).otherwise(F.array().cast("array<string>"))
    marked = docs.withColumns(gaps).withColumns(found)
    parts = [_spans(k, F.col(f"_pii_gap_{k.name}"), F.col(f"_pii_hit_{k.name}")) for k in KINDS]
    return marked.withColumn(out, F.concat(*parts)).drop(*gaps, *found)


def spans_text(spans: Column) -> Column:
    """Spans as kind:start:stop, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(docs: DataFrame, text_col: str = "text", least_score: float = 0.0) -> DataFrame:
    """The rows with each span of a score of at least ``least_score`` replaced by its kind, as ``<EMAIL>``.

    Overlapping spans are replaced together, under the kind that starts first. With
    a ``least_score`` above a kind's confidence, spans of that kind are replaced
    only where a context word stands near; at 0 all are.
    A null text stays null. Columns stay as they are, but for the text.
    """
    marked = with_spans(docs, text_col, "_pii_spans")
    chosen = F.array_sort(
        F.transform(
            F.filter("_pii_spans", lambda s: s["score"] >= least_score),
            lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")),
        )
    )
    cut = "struct<start:int,stop:int,kind:string>"
    # The span that may still grow is held back until the next one begins behind it.
    nothing = F.lit(None).cast(cut)

    def merge(held: Column, s: Column) -> tuple[Column, Column]:
        overlaps = F.coalesce(held["stop"] > s["start"], F.lit(False))
        joined = F.struct(held["start"].alias("start"), F.greatest(held["stop"], s["stop"]).alias("stop"), held["kind"].alias("kind"))
        out = F.when(overlaps | held.isNull(), F.array().cast(f"array<{cut}>")).otherwise(F.array(held))
        return F.when(overlaps, joined).otherwise(s).cast(cut), out

    marked = marked.withColumn("_pii_merged", _folded(chosen, nothing, merge, cut))
    last = F.col("_pii_merged.held")
    ends = F.when(last.isNotNull(), F.array(last)).otherwise(F.array().cast(f"array<{cut}>"))
    marked = marked.withColumn("_pii_cut", F.concat("_pii_merged.out", ends))
    # With four bytes per code point a piece is cut out without reading what is before it.
    points = F.encode(F.col(text_col), "UTF-32")
    marked = marked.withColumn("_pii_points", F.when(F.size("_pii_cut") > 0, points))

    def piece(start: Column, stop: Column) -> Column:
        return F.decode(F.substring(F.col("_pii_points"), 4 * start + 1, 4 * (stop - start)), "UTF-32")

    def before(s: Column, i: Column) -> Column:
        start = F.when(i > 0, F.get(F.col("_pii_cut"), i - 1)["stop"]).otherwise(0)
        return F.concat(piece(start, s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))

    end = F.get(F.col("_pii_cut"), F.size("_pii_cut") - 1)["stop"]
    rest = piece(end, (F.length("_pii_points") / 4).cast("int"))
    redacted = F.concat(F.array_join(F.transform("_pii_cut", before), ""), rest)
    return marked.withColumn(text_col, F.when(F.size("_pii_cut") > 0, redacted).otherwise(F.col(text_col))).select(docs.columns)
