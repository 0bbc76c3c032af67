"""Personal data: patterns propose, checksums confirm, context adjusts.

All of it is one projection of DataFrame functions (no shuffle, no Python):
for each kind the pattern's matches and the text between them are taken from
the text, positions are running sums of their lengths in code points, and
validators drop matches that fail (parts of an IP address up to 255, Luhn for
card numbers, digit counts for phone numbers, mod-97 for IBANs).

Base kinds (email, ip, card, phone) stay whenever their validator holds.  The
method adds IBANs, national phone numbers and social security numbers.  Each
span has a score: the kind's own weight, plus a bonus if a word of the kind's
context list stands within 60 characters before it; added spans below
``THRESHOLD`` are dropped, as are added spans that overlap a base span.

Patterns are possessive and anchored at the start of a run, so long runs of
digits or letters take linear time and no recursion.  Null text is empty; a
text may be of any length (running sums are built in blocks).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
CONTEXT_BONUS = 0.35
CONTEXT_CHARS = 60
_BLOCK = 512
_TEXT_BLOCK = 4096

_LOCAL = r"[A-Za-z0-9._%+-]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _luhn(match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _mod97(match: Column) -> Column:
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    letters = F.regexp_extract_all(moved, F.lit("."), F.lit(0))
    return F.length(plain).between(15, 34) & (F.aggregate(letters, F.lit(0), add) == 1)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    guard: str                      # cheap test that every text with a match passes
    weight: float
    base: bool = True
    words: tuple[str, ...] = field(default=())

    def valid(self, match: Column) -> Column:
        if self.name == "ip":
            return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
        if self.name == "card":
            return _luhn(match)
        if self.name == "phone":
            return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
        if self.name == "iban":
            return _mod97(match)
        return F.lit(True)


KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         words=("mail", "contact", "correo", "courriel")),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.7, words=("ip", "host", "server", "address")),
    # a whole chain of digits with single blanks or hyphens between, if it has 12 to 19 digits
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){11,18}+(?![ -]?[0-9])", "[0-9](?:[ -]?[0-9]){11}", 0.8,
         words=("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta")),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", 0.7, words=("phone", "tel", "call", "mobile", "fax", "telefon", "appelez")),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
         "[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", 0.8, base=False, words=("iban", "account", "konto", "compte", "cuenta")),
    Kind("national_phone", r"(?<![0-9+])(?<!\+[0-9]{1,3}[ .-]{0,2}\(?)(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
         "[0-9]{3}[ .-][0-9]{4}", 0.35, base=False, words=("phone", "tel", "call", "mobile", "fax", "telefon")),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.4,
         base=False, words=("ssn", "social security", "taxpayer")),
)

_SPAN = "array<struct<start:int,rank:int,end:int,score:double>>"


def _running(lengths: Column) -> Column:
    """Inclusive running sums of an int array, block by block so that the cost
    of appending stays bounded on very long arrays."""
    blocks = F.transform(F.sequence(F.lit(0), F.size(lengths) - 1, F.lit(_BLOCK)), lambda b: F.slice(lengths, b + 1, _BLOCK))

    def sums(x: Column) -> Column:
        return F.aggregate(x, F.array().cast("array<int>"),
                           lambda acc, v: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + v))

    local = F.transform(blocks, sums)
    offsets = F.aggregate(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda a, v: a + v)), F.array(F.lit(0)),
                          lambda acc, v: F.array_append(acc, F.element_at(acc, -1) + v))
    return F.flatten(F.zip_with(local, F.slice(offsets, F.lit(1), F.size(blocks)), lambda x, o: F.transform(x, lambda v: v + o)))


def _kind_spans(df: DataFrame, text: str, kind: Kind, rank: int, out: str) -> DataFrame:
    """Add column ``out``: the kind's confirmed spans (all, for a base kind)."""
    hit = F.col("_digit") | F.lit(kind.name == "email")
    hit = hit & (F.contains(F.col(text), F.lit("@")) if kind.guard == "@" else F.col(text).rlike(kind.guard))
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(hit, F.regexp_extract_all(F.col(text), F.lit(kind.pattern), F.lit(0))).otherwise(none))
    found = F.size("_m") > 0
    df = df.withColumn("_p", F.when(found, F.split(F.col(text), kind.pattern, -1)).otherwise(none))
    sums = _running(F.zip_with(F.slice("_p", F.lit(1), F.size("_m")), F.col("_m"), lambda p, m: F.length(p) + F.length(m)))
    df = df.withColumn("_e", F.when(found, sums).otherwise(F.array().cast("array<int>")))
    words = "|".join(kind.words)
    near = rf"(?i)(?<![\p{{L}}])(?:{words})"

    def span(z: Column) -> Column:
        score = F.lit(kind.weight) + F.when(F.right(z["_p"], F.lit(CONTEXT_CHARS)).rlike(near), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
        return F.struct((z["_e"] - F.length(z["_m"])).alias("start"), F.lit(rank).alias("rank"), z["_e"].alias("end"),
                        F.least(score, F.lit(1.0)).alias("score"))

    zipped = F.arrays_zip("_m", "_e", F.slice("_p", F.lit(1), F.size("_m")).alias("_p"))
    spans = F.transform(F.filter(zipped, lambda z: kind.valid(z["_m"])), span)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    return df.withColumn(out, F.when(found, spans.cast(_SPAN)).otherwise(F.array().cast(_SPAN))).drop("_m", "_p", "_e")


def find_spans(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``_text`` (never null), ``base`` and ``spans``:
    arrays of (start, rank, end, score) by start, then kind; ``rank`` indexes
    ``KINDS``; positions are code points, end exclusive."""
    df = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    df = df.withColumn("_digit", F.col("_text").rlike("[0-9]"))
    for rank, kind in enumerate(KINDS):
        df = _kind_spans(df, "_text", kind, rank, f"_s{rank}")
    df = df.drop("_digit")
    base = [f"_s{r}" for r, k in enumerate(KINDS) if k.base]
    added = [f"_s{r}" for r, k in enumerate(KINDS) if not k.base]
    df = df.withColumn("base", F.array_sort(F.concat(*base)))
    more = F.filter(F.concat(*added), lambda s: ~F.exists(F.col("base"), lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    df = df.withColumn("spans", F.when(F.size(F.concat(*added)) > 0, F.array_sort(F.concat(F.col("base"), more))).otherwise(F.col("base")))
    return _settled(df, [*keep, "_text"], ["base", "spans"])


def _settled(df: DataFrame, keep: list[str], made: list[str]) -> DataFrame:
    """``keep`` and ``made`` columns, the latter through a one-element
    generator: conditions that callers put on them are evaluated on the values
    and not pushed down as copies of the long expressions that made them."""
    row = F.explode(F.array(F.struct(*[F.col(c).alias(c) for c in made]))).alias("_made")
    return df.select(*[F.col(f"`{c}`") for c in keep], row).select(*[F.col(f"`{c}`") for c in keep], *[F.col("_made").getField(c).alias(c) for c in made])


def span_list(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1),
                                                                       s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans."""
    found = find_spans(docs, text_col, (id_col,))

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(r).alias(f"n_{k.name}") for r, k in enumerate(KINDS) if k.base]
    return found.select(id_col, *counts, F.sha2(span_list("base"), 256).alias("base_sha256"), span_list("spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets
    (overlapping spans become one replacement, named after the first); null
    text stays null and other columns stay as they are, but for
    ``length_col``, which follows the text."""
    others = tuple(docs.columns)
    df = find_spans(docs, text_col, others)
    # spans whose start lies behind all earlier ends open a new stretch; stretches are (start, rank, end)
    empty = F.array().cast("array<struct<start:int,rank:int,end:int>>")

    def join(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), last["rank"].alias("rank"), F.greatest(last["end"], s["end"]).alias("end"))
        fresh = F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))
        return F.when(s["start"] < last["end"], F.array_append(F.slice(acc, F.lit(1), F.size(acc) - 1), grown)).otherwise(
            F.array_append(acc, fresh))

    df = df.withColumn("_st", F.when(F.size("spans") > 0, F.aggregate("spans", empty, join)).otherwise(empty))
    some = F.size("_st") > 0
    # the text in blocks of code points, so that a gap costs its own length
    df = df.withColumn("_b", F.when(some, F.regexp_extract_all(F.col("_text"), F.lit(f"(?s).{{1,{_TEXT_BLOCK}}}"), F.lit(0))))

    def piece(a: Column, b: Column) -> Column:
        first, last = F.floor(a / _TEXT_BLOCK).cast("int"), F.floor(b / _TEXT_BLOCK).cast("int")
        joined = F.array_join(F.slice(F.col("_b"), first + 1, last - first + 1), "")
        return F.substring(joined, a - first * _TEXT_BLOCK + 1, b - a)

    names = F.array(*[F.lit(f"[{k.name.upper()}]") for k in KINDS])
    starts = F.concat(F.array(F.lit(0)), F.transform("_st", lambda s: s["end"]))
    stops = F.concat(F.transform("_st", lambda s: s["start"]), F.array(F.length("_text")))
    tails = F.concat(F.transform("_st", lambda s: F.element_at(names, s["rank"] + 1)), F.array(F.lit("")))
    parts = F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b"), tails.alias("t")),
                        lambda z: F.concat(piece(z["a"], z["b"]), z["t"]))
    df = df.withColumn("_new", F.when(some, F.array_join(parts, "")).otherwise(F.col(f"`{text_col}`"))).withColumn("_some", some)
    df = _settled(df, list(others), ["_new", "_some"])
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.col("_new").alias(c))
        elif c == length_col:
            kind = docs.schema[c].dataType
            out.append(F.when(F.col("_some"), F.length("_new").cast(kind)).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)
