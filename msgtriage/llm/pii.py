"""Personal data: regular expressions propose, checksums confirm, context words score.

Everything is a DataFrame expression. Spans are code point offsets, end exclusive.
A pattern's spans come from two views of one scan: the matches themselves and the
text between them; running totals of both lengths give the offsets. Running totals and
maxima are taken in runs of ``RUN`` numbers, and texts are read by pieces of ``PIECE``
code points, so the time is in proportion to the text, however many spans it holds.

Base kinds, leftmost and non-overlapping per kind, failing matches dropped:
``email``; ``ip`` (parts at most 255); ``card`` (16 to 19 digits, Luhn); ``phone``
(leading +, 8 to 15 digits). The patterns are written so that the engine never backtracks
through a long run and never recurses per character; a look-behind (or ``\\G``, the end
of the last match) keeps them at the positions where the plain pattern would start.

Added rules give more spans: ``iban`` (mod 97); a card or an international phone number
that stands beside other digits, so that the base match is too long and dropped
(``card_run`` with Luhn, ``phone_run``); and, where a context word confirms them, cards
of 13 to 15 digits (``card_short``, Luhn), national numbers (``phone_local``) and
``ssn`` (3-2-4 digits). Each span has a score: a start value by rule, raised where a
context word stands within ``CONTEXT`` characters before it; added spans count from
``MIN_SCORE`` and only where no base span overlaps them.

Defined results: a null or empty text has no spans (:func:`redact` leaves it as it is); an
empty table gives an empty table; whole texts are searched, whatever their length;
repeated rows give repeated rows. Base spans of different kinds may overlap; an added span that
overlaps a base span is left out, added spans that overlap each other all stand. Only the
text is read; :func:`find` and :func:`redact` keep all columns whatever their names,
:func:`find` refuses a name for its own column that is taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgtriage.llm.decontaminate import unused

CONTEXT = 40
RUN = 256
PIECE = 512
MIN_SCORE = 0.6

EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
    r"[A-Za-z0-9.-]*?(?=\z|[^A-Za-z0-9.-]|\.(?![A-Za-z0-9-]))"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGIT_RUN = r"(?<![0-9])[0-9][ -]?[0-9][0-9 -]*?(?=\z|[^0-9 -]|[ -](?![0-9]))"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
LOCAL_PHONE = r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

CARD_RUN = r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"
PHONE_RUN = r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"

BASE = ("email", "ip", "card", "phone")
CARD_WORDS = r"card|visa|master|amex|credit|carte|karte|tarjeta"
PHONE_WORDS = r"phone|tel\b|tel[.:]|call|mobile|fax|téléphone|telefon|teléfono"
# rule -> (kind, score without context, context words); the base rules are named as their kinds
RULES: dict[str, tuple[str, float, str]] = {
    "email": ("email", 1.0, r"e-?mail|contact|write to"),
    "ip": ("ip", 0.8, r"\bip\b|address|host|server"),
    "card": ("card", 0.9, CARD_WORDS),
    "phone": ("phone", 0.8, PHONE_WORDS),
    "card_run": ("card", 0.7, CARD_WORDS),
    "card_short": ("card", 0.3, CARD_WORDS),
    "phone_run": ("phone", 0.7, PHONE_WORDS),
    "phone_local": ("phone", 0.4, PHONE_WORDS),
    "iban": ("iban", 0.9, r"iban|account|konto|compte|cuenta"),
    "ssn": ("ssn", 0.3, r"ssn|social security|sozialversicherung|sécurité sociale|seguridad social"),
}
BONUS = 0.4
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn_ok(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    d = lambda x, i: F.substring(x, i, 1).cast("int")
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(back)),
        F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, d(back, i)).otherwise(F.pmod(d(back, i) * 2, F.lit(10)) + F.floor(d(back, i) * 2 / 10).cast("int")),
    )
    return F.pmod(total, F.lit(10)) == 0


def mod97_ok(iban: Column) -> Column:
    """Whether an IBAN (spaces removed) has remainder 1 modulo 97."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    code = lambda i: F.ascii(F.substring(moved, i, 1))
    rest = F.aggregate(
        F.sequence(F.lit(1), F.length(moved)),
        F.lit(0),
        lambda r, i: F.when(code(i) < 58, F.pmod(r * 10 + code(i) - 48, F.lit(97))).otherwise(F.pmod(r * 100 + code(i) - 55, F.lit(97))),
    )
    return rest == 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _running(numbers: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals (or maxima) from 0 of an array of ints."""
    none = F.expr("cast(array() as array<int>)")

    def of_run(run: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), none.alias("out"))

        def step(acc: Column, x: Column) -> Column:
            at = join(acc["at"], x)
            return F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

        return F.aggregate(run, zero, step, lambda acc: acc["out"])

    def of_runs(runs: Column) -> Column:
        ends = of_run(F.transform(runs, lambda run: F.aggregate(run, F.lit(0), join)), F.lit(0))
        before = lambda ends, k: F.when(k == 0, F.lit(0)).otherwise(F.try_element_at(ends, k))
        return _let(ends, lambda ends: F.flatten(F.transform(runs, lambda run, k: of_run(run, before(ends, k)))))

    def cut(all_: Column) -> Column:
        heads = F.sequence(F.lit(1), F.size(all_), F.lit(RUN))
        return F.when(F.size(all_) > 0, _let(F.transform(heads, lambda k: F.slice(all_, k, RUN)), of_runs)).otherwise(none)

    return _let(numbers, cut)


def _spans(text: Column, pattern: str, matches: Column) -> Column:
    """Spans of all matches of one pattern with their offsets."""
    none = F.expr("cast(array() as array<struct<first:int,end:int,value:string>>)")
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    ends = _running(F.zip_with(gaps, matches, lambda g, m: F.length(g) + F.length(m)), lambda a, b: a + b)
    found = F.zip_with(ends, matches, lambda end, m: F.struct((end - F.length(m)).alias("first"), end.alias("end"), m.alias("value")))
    return F.when(F.size(matches) > 0, found).otherwise(none)


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}" % PIECE), F.lit(0))


def _part(pieces: Column, first: Column, end: Column) -> Column:
    """The text from ``first`` to ``end``, of its pieces."""
    lo = F.floor(first / PIECE).cast("int")
    some = F.slice(pieces, lo + 1, F.floor((end - 1) / PIECE).cast("int") - lo + 1)
    return F.when(first < end, F.substring(F.array_join(some, ""), first - lo * PIECE + 1, end - first)).otherwise(F.lit(""))


def _scored(pieces: Column, spans: Column, rule: str) -> Column:
    kind, start_score, words = RULES[rule]

    def one(pieces: Column, s: Column) -> Column:
        near = F.lower(_part(pieces, F.greatest(s["first"] - CONTEXT, F.lit(0)), s["first"]))
        score = F.least(F.lit(1.0), F.lit(start_score) + F.when(near.rlike(words), F.lit(BONUS)).otherwise(F.lit(0.0)))
        return F.struct(F.lit(kind).alias("kind"), s["first"].alias("first"), s["end"].alias("end"), F.lit(rule).alias("rule"), s["value"].alias("value"), score.alias("score"))

    return _let(pieces, lambda p: F.transform(spans, lambda s: one(p, s)))


def _clear(added: Column, base: Column) -> Column:
    """The added spans that overlap no base span: of the base spans that begin before
    a span's end none ends after its start."""
    begin = F.transform(base, lambda b: F.struct(b["first"].alias("at"), F.lit(1).alias("turn"), b["end"].alias("till"), F.lit(None).cast("int").alias("nth")))
    ask = F.transform(added, lambda s, k: F.struct(s["end"].alias("at"), F.lit(0).alias("turn"), F.lit(0).alias("till"), k.alias("nth")))

    def of(events: Column, added: Column) -> Column:
        reach = _running(F.transform(events, lambda e: e["till"]), _larger)
        both = F.zip_with(events, reach, lambda e, r: F.struct(e["nth"].alias("nth"), r.alias("reach")))
        asked = F.transform(F.filter(both, lambda x: x["nth"].isNotNull()), lambda x: F.struct(F.element_at(added, x["nth"] + 1).alias("span"), x["reach"].alias("reach")))
        return F.transform(F.filter(asked, lambda x: x["reach"] <= x["span"]["first"]), lambda x: x["span"])

    return F.when(F.size(added) > 0, _let(added, lambda a: _let(F.array_sort(F.concat(begin, ask)), lambda e: of(e, a)))).otherwise(added)


def find(docs: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: an array of (kind, first, end, rule, value, score), by kind
    (``email``, ``ip``, ``card``, ``phone``, ``iban``, ``ssn``), then position."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"documents have a column {name} already; choose another name")
    pii, at_, parts, kept, base_ = helpers = [unused(c, docs.columns) for c in ("__pii", "__at", "__parts", "__kept", "__base")]
    col = F.coalesce(F.col(text), F.lit(""))
    hint = {
        "email": F.contains(col, F.lit("@")), "ip": col.rlike(r"[0-9]\.[0-9]"), "run": col.rlike(r"[0-9](?:[ -]?[0-9]){12}"), "phone": F.contains(col, F.lit("+")),
        "iban": col.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"), "local": col.rlike(r"[0-9]{3}[ .-][0-9]{4}"), "ssn": col.rlike(r"[0-9]{3}-[0-9]{2}-"),
    }
    hint |= {"card_run": hint["run"], "phone_run": hint["phone"]}
    patterns = {"email": EMAIL, "ip": IP, "run": DIGIT_RUN, "phone": PHONE, "iban": IBAN, "local": LOCAL_PHONE, "ssn": SSN, "card_run": CARD_RUN, "phone_run": PHONE_RUN}
    nothing = F.expr("cast(array() as array<string>)")
    step = docs.withColumn(pii, F.struct(*[F.when(hint[k], F.regexp_extract_all(col, F.lit(p), F.lit(0))).otherwise(nothing).alias(k) for k, p in patterns.items()]))
    step = step.withColumn(at_, F.struct(*[_spans(col, p, F.col(pii)[k]).alias(k) for k, p in patterns.items()]))
    some = F.greatest(*[F.size(F.col(pii)[k]) for k in patterns]) > 0
    step = step.withColumn(parts, F.when(some, _pieces(col)).otherwise(nothing))
    at = F.col(at_)
    n = lambda s: F.length(_digits(s["value"]))
    keep = {
        "email": at["email"],
        "ip": F.filter(at["ip"], lambda s: s["value"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        "card": F.filter(at["run"], lambda s: n(s).between(16, 19) & luhn_ok(_digits(s["value"]))),
        "phone": F.filter(at["phone"], lambda s: n(s).between(8, 15)),
        "card_run": F.filter(at["card_run"], lambda s: luhn_ok(_digits(s["value"]))),
        "card_short": F.filter(at["run"], lambda s: n(s).between(13, 15) & luhn_ok(_digits(s["value"]))),
        "phone_run": F.filter(at["phone_run"], lambda s: n(s).between(8, 15)),
        "phone_local": at["local"],
        "iban": F.filter(at["iban"], lambda s: mod97_ok(F.regexp_replace(s["value"], " ", ""))),
        "ssn": at["ssn"],
    }
    step = step.withColumn(kept, F.struct(*[_scored(F.col(parts), v, k).alias(k) for k, v in keep.items()]))
    step = step.withColumn(base_, F.concat(*[F.col(kept)[k] for k in BASE]))
    by_kind = []
    for kind in dict.fromkeys(k for k, _, _ in RULES.values()):
        rules = [r for r, (k, _, _) in RULES.items() if k == kind]
        own = [F.col(kept)[r] if r in BASE else _clear(F.filter(F.col(kept)[r], lambda s: s["score"] >= MIN_SCORE), F.col(base_)) for r in rules]
        by_kind.append(F.array_sort(F.concat(*own)))
    return step.withColumn(name, F.concat(*by_kind)).drop(*helpers)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ",")


def report(found: DataFrame) -> DataFrame:
    """Digest of :func:`find`: counts of the base kinds, the hash of the base spans
    and all spans as ``kind:first:end``."""
    base = F.filter("spans", lambda s: s["rule"].isin(*BASE))
    rules = F.transform("spans", lambda s: s["rule"])
    counts = [(F.size("spans") - F.size(F.array_remove(rules, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span found replaced by its kind, e.g. ``<EMAIL>``; where spans
    overlap, the one that starts first (the longer, if both do) stands for all."""
    name, parts, reached = (unused(c, docs.columns) for c in ("__spans", "__parts", "__reach"))
    found = find(docs, text, name)
    some = F.size(name) > 0
    label = lambda s: F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
    order = F.array_sort(F.transform(name, lambda s: F.struct(s["first"].alias("first"), (-s["end"]).alias("till"), label(s).alias("label"))))
    found = found.withColumn(name, order).withColumn(parts, F.when(some, _pieces(F.col(text))))
    found = found.withColumn(reached, _running(F.transform(name, lambda s: -s["till"]), _larger))

    def body(pieces: Column, reach: Column) -> Column:
        """Of each span that begins outside all before it the text since these and its label, then the rest."""
        before = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.try_element_at(reach, k))
        own = lambda s, k: F.when(s["first"] >= before(k), F.concat(_part(pieces, before(k), s["first"]), s["label"])).otherwise(F.lit(""))
        rest = _part(pieces, F.try_element_at(reach, F.lit(-1)), F.length(text))
        return F.concat(F.array_join(F.transform(name, own), ""), rest)

    done = _let(F.col(parts), lambda p: _let(F.col(reached), lambda r: body(p, r)))
    return found.withColumn(text, F.when(some, done).otherwise(F.col(text))).drop(name, parts, reached)
