"""Personal data in texts: regular expressions propose spans, checksums confirm them, context words adjust the score.

DataFrame functions only, without a shuffle. A kind's proposals come from one scan of a text and the stretches between
them from another, so that running sums of lengths give positions and the stretches give each proposal its context.
The expressions are written so that a scan is linear: a run of characters is entered at its first one alone and never
given back, and a number of digits is counted by the expression instead of after it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points on each side of a proposal that are searched for context words.
REACH = 40
#: A proposal of the method stays from this score on, in percent. Those of the base kinds stay with any.
LEAST = 60
#: What a context word adds, and what a word that speaks against a kind takes away, in percent.
WITH_CONTEXT, AGAINST = 30, 40

_MAIL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: A dotted quad whose parts are at most 255.
ADDRESS = rf"^{_OCTET}(\.{_OCTET}){{3}}$"

# Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "XK": 20,
}

# Context words by what they speak of.
_CARD = ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "tarjeta", "carte")
_PHONE = ("phone", "tel", "call", "fax", "mobile", "cell", "telefon", "handy", "téléphone")
_BANK = ("iban", "bank", "account", "konto", "cuenta", "compte")
_PERSON = ("ssn", "social", "security", "taxpayer")
_NET = ("ip", "host", "server", "client", "address")
_MAILS = ("mail", "email", "contact", "write")
_THINGS = ("order", "invoice", "isbn", "serial", "version", "tracking", "article", "part", "model")


def no_check(text: Column) -> Column:
    return F.lit(True)


def is_address(text: Column) -> Column:
    return text.rlike(ADDRESS)


def passes_luhn(text: Column) -> Column:
    return F.call_function("luhn_check", F.regexp_replace(text, "[ -]", ""))


def passes_mod_97(text: Column) -> Column:
    """Check digits of an IBAN, and its length by country; letters count from 10 on, the first four signs come last."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))

    def step(rest: Column, sign: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), sign) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return (iban_length(text) == F.char_length(plain)) & (F.aggregate(F.split(moved, ""), F.lit(0), step) == 1)


def iban_length(text: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])[F.substring(text, 1, 2)]


def is_social(text: Column) -> Column:
    """Areas 000, 666 and 9xx, group 00 and serial 0000 are never given out."""
    return ~text.rlike("^(000|666|9)|-00-|-0000$")


def iban_end(text: Column) -> Column:
    """Groups of four may run on into the next words: the country's length tells where the number ends."""
    length = iban_length(text)
    return F.when(F.substring(text, 5, 1) == " ", F.left(text, length + F.floor((length - 1) / 4).cast("int"))).otherwise(text)


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``check`` confirms, ``words`` around a proposal raise its score and ``others`` lower it.

    ``whole``: no letter or digit may stand beside the span. ``cut`` shortens a proposal before it is checked.
    ``needs`` stands in each proposal, so that a text without it is not scanned; empty: a digit does.
    ``base``: confirmed proposals stay with any score.
    """

    name: str
    pattern: str
    score: int
    check: Callable[[Column], Column] = no_check
    words: tuple[str, ...] = ()
    others: tuple[str, ...] = _THINGS
    needs: str = ""
    base: bool = False
    whole: bool = False
    cut: Callable[[Column], Column] | None = None


#: The kinds in the order in which spans are listed. Those of the contract come first.
KINDS = (
    Kind("email", rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 90, words=_MAILS, others=(), needs="@", base=True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 60, is_address, _NET, needs=".", base=True),
    # A whole chain of digits, of 13 to 19.
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])", 70, passes_luhn, _CARD, base=True),
    # As many signs as there are up to the last digit, with 9 to 15 digits.
    Kind("phone", r"\+[0-9](?:[ ().-]*+[0-9]){8,14}+(?![ ().-]*+[0-9])", 80, words=_PHONE, needs="+", base=True),
    Kind(
        "iban", "[A-Z][A-Z][0-9][0-9](?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)", 80, passes_mod_97, _BANK,
        whole=True, cut=iban_end,
    ),
    Kind("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 40, is_social, _PERSON, whole=True),
    Kind("local_phone", r"\(?[0-9]{3}[).-] ?[0-9]{3}[ .-][0-9]{4}", 40, words=_PHONE, whole=True),
    # Card numbers that stand in a chain of digits with others.
    Kind("card_part", "[0-9]{13,19}", 40, passes_luhn, _CARD, whole=True),
)
BASE = tuple(k.name for k in KINDS if k.base)

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def any_word(words: tuple[str, ...]) -> str:
    """Expression for one of the words, with nothing but a letter of the context's language to end it."""
    return f"(^|[^a-z])({'|'.join(words)})([^a-z]|$)"


def _running(blocks: Column) -> Column:
    """Running sums over blocks of running sums (each with a leading zero), as one array."""
    before = F.aggregate(
        blocks, F.array(F.lit(0).cast("long")), lambda sums, block: F.concat(sums, F.array(F.element_at(sums, -1) + F.element_at(block, -1)))
    )
    pairs = F.zip_with(blocks, F.slice(before, 1, F.size(blocks)), lambda block, base: F.struct(block.alias("block"), base.alias("base")))
    return F.flatten(F.transform(pairs, lambda p: F.transform(F.slice(p["block"], 2, F.size(p["block"]) - 1), lambda x: x + p["base"])))


def _sum_blocks(steps: Column) -> Column:
    """Running sums within blocks of the square root's length, so that n sums cost about n ** 1.5 steps and not n ** 2."""
    width = F.ceil(F.sqrt(F.size(steps))).cast("int")

    def block(at: Column) -> Column:
        return F.aggregate(
            F.slice(steps, at, width), F.array(F.lit(0).cast("long")), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
        )

    return F.transform(F.sequence(F.lit(1), F.size(steps), width), block)


def _judged(kind: Kind, z: Column) -> Column:
    """A proposal ``z`` (text, start, before, after) as a struct with its score; a null where it is dropped."""
    text = kind.cut(z["text"]) if kind.cut else z["text"]
    around = F.translate(F.concat(F.right(z["before"], F.lit(REACH)), F.lit("\n"), F.left(z["after"], F.lit(REACH))), *_LOWER)
    score = F.lit(kind.score)
    for words, change in ((kind.words, WITH_CONTEXT), (kind.others, -AGAINST)):
        if words:
            score = score + F.when(around.rlike(any_word(words)), change).otherwise(0)
    kept = F.coalesce(kind.check(text), F.lit(False))
    if kind.whole:
        # Beside an empty stretch stands another proposal, or an end of the text.
        left = F.when(z["before"] == "", z["start"] == 0).otherwise(~F.right(z["before"], F.lit(1)).rlike("[A-Za-z0-9]"))
        rest = F.concat(F.substr(z["text"], F.char_length(text) + 1), z["after"])
        right = F.when(rest == "", z["last"]).otherwise(~F.left(rest, F.lit(1)).rlike("[A-Za-z0-9]"))
        kept = kept & left & right
    if not kind.base:
        kept = kept & (score >= LEAST)
    start = z["start"]
    return F.when(
        kept,
        F.struct(
            F.lit(kind.name).alias("kind"),
            start.alias("start"),
            (start + F.char_length(text)).alias("end"),
            text.alias("text"),
            F.greatest(F.lit(0), F.least(F.lit(100), score)).alias("score"),
        ),
    )


def find_spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` as ``doc_id, text, spans``: an array of (kind, start, end, text, score), by kind as listed, then start.

    Start and end count code points, the end is exclusive. Proposals of a kind are the leftmost ones that do not
    overlap; one that fails its check is dropped as a whole. The score, in percent, is the kind's own with what the
    ``REACH`` code points on each side, up to the next proposal of the kind, add or take away.

    A null text counts as empty and has no spans; texts are read whole however long they are. Each row stands for
    itself: repeated rows and null ids stay rows. An empty table gives no rows. Other columns are ignored.
    """
    frame = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n, none = len(kinds), F.array().cast("array<string>")
    # Each step needs what the one before it has made more than once, so no step is evaluated twice.
    frame = frame.select("*", F.col("text").rlike("[0-9]").alias("_digits"))
    frame = frame.select("*", *[
        F.when(
            F.contains(F.col("text"), F.lit(k.needs)) if k.needs else F.col("_digits"), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))
        ).otherwise(none).alias(f"_found{i}")
        for i, k in enumerate(kinds)
    ])
    frame = frame.select("*", *[
        F.when(F.size(f"_found{i}") > 0, F.split("text", k.pattern, -1)).otherwise(none).alias(f"_gaps{i}") for i, k in enumerate(kinds)
    ])
    frame = frame.select("*", *[
        F.zip_with(
            F.slice(f"_gaps{i}", 1, F.size(f"_found{i}")),
            F.concat(F.array(F.lit("")), F.slice(f"_found{i}", 1, F.greatest(F.size(f"_found{i}") - 1, F.lit(0)))),
            lambda gap, text: (F.char_length(gap) + F.char_length(text)).cast("long"),
        ).alias(f"_steps{i}")
        for i in range(n)
    ])
    frame = frame.select("*", *[F.when(F.size(f"_found{i}") > 0, _sum_blocks(F.col(f"_steps{i}"))).alias(f"_sums{i}") for i in range(n)])
    spans = []
    for i, kind in enumerate(kinds):
        size = F.size(f"_found{i}")
        zipped = F.arrays_zip(
            F.col(f"_found{i}").alias("text"),
            _running(F.col(f"_sums{i}")).alias("start"),
            F.slice(f"_gaps{i}", 1, size).alias("before"),
            F.slice(f"_gaps{i}", 2, size).alias("after"),
            F.concat(F.array_repeat(F.lit(False), size - 1), F.array(F.lit(True))).alias("last"),
        )
        judged = F.transform(zipped, partial(_judged, kind))
        spans.append(F.when(size > 0, F.filter(judged, lambda s: s.isNotNull())))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,text:string,score:int>>")
    return frame.select("doc_id", "text", F.concat(*[F.coalesce(s, empty) for s in spans]).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(name: str, span: Column) -> Column:
    return span["kind"] == name


def redact(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``doc_id, text`` with each span replaced by its kind in angle brackets; of spans that overlap the longest is.

    Rows as in :func:`find_spans`; a null text becomes empty.
    """
    found = find_spans(docs, kinds)
    # From the left; a span that begins within the one before it only lengthens it.
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], (-s["end"]).alias("less"), s["kind"])))
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        end = -span["less"]
        gap = F.substr(F.col("text"), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        new = F.concat(state["done"], gap, F.lit("<"), span["kind"], F.lit(">"))
        return F.struct(
            F.when(span["start"] >= state["at"], new).otherwise(state["done"]).alias("done"),
            F.greatest(state["at"], end).alias("at"),
        )

    rest = F.aggregate(by_start, start, step, lambda s: F.concat(s["done"], F.substr(F.col("text"), (s["at"] + 1).cast("int"))))
    return found.select("doc_id", rest.alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """The spans of :func:`find_spans` counted and listed, one row for each row of ``docs``.

    ``n_email, n_ip, n_card, n_phone`` and ``base_sha256`` tell of the base kinds, ``spans`` of all. A text without
    spans has the digest of the empty list.
    """
    found = find_spans(docs).withColumn("base", F.filter("spans", lambda s: s["kind"].isin(*BASE)))
    counts = [F.size(F.filter("base", partial(_of_kind, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )


# The expressions of the contract, for the SQL.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def luhn(digits: str) -> str:
        value = f"CAST(substr(reverse({digits}), i, 1) AS INT)"
        doubled = f"(({value} * 2) // 10 + ({value} * 2) % 10)"
        return f"list_sum([CASE WHEN i % 2 = 1 THEN {value} ELSE {doubled} END FOR i IN range(1, length({digits}) + 1)]) % 10 = 0"

    digits = "regexp_replace(x, '[^0-9]', '', 'g')"
    signs = "substr(replace(x, ' ', ''), 5) || left(x, 4)"
    # Each sign as its number; what the numbers before it leave is carried on as three digits at most.
    number = "string_agg(CAST(strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr({0}, n, 1)) - 1 AS VARCHAR), '' ORDER BY n)"
    checks = {
        "ip": f"regexp_matches(x, {text(ADDRESS)})",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn(digits)}",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": "wide = length(replace(x, ' ', '')) AND rest = 1",
        "ssn": "NOT regexp_matches(x, '^(000|666|9)|-00-|-0000$')",
        "card_part": luhn("x"),
    }
    proposals = " UNION ALL ".join(
        f"SELECT r, {i} AS k, regexp_extract_all(t, {text(_PLAIN.get(k.name, k.pattern))}) AS found, "
        f"string_split_regex(t, {text(_PLAIN.get(k.name, k.pattern))}) AS gaps FROM d"
        for i, k in enumerate(KINDS)
    )
    lengths = ", ".join(f"{text(c)}: {n}" for c, n in IBAN_LENGTHS.items())

    def case(column: str, values: list[str]) -> str:
        return f"CASE {column} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"

    def score(kind: Kind) -> str:
        parts = [str(kind.score)]
        for words, change in ((kind.words, WITH_CONTEXT), (kind.others, -AGAINST)):
            if words:
                parts.append(f"(CASE WHEN regexp_matches(around, {text(any_word(words))}) THEN {change} ELSE 0 END)")
        return " + ".join(parts)

    kept = [
        f"({checks.get(k.name, 'true')})"
        + (" AND free_left AND free_right" if k.whole else "")
        + ("" if k.base else f" AND {score(k)} >= {LEAST}")
        for k in KINDS
    ]
    iban = next(i for i, k in enumerate(KINDS) if k.name == "iban")
    base = ", ".join(str(i) for i, k in enumerate(KINDS) if k.base)
    counts = ", ".join(f"count(*) FILTER (k = {i}) AS n_{k.name}" for i, k in enumerate(KINDS) if k.base)
    listed = "coalesce(string_agg(name || ':' || start || ':' || (start + length(x)), ',' ORDER BY k, start){}, '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
p AS ({proposals}),
u AS (
  SELECT r, k, unnest(found) AS m, unnest(gaps[1:len(found)]) AS before, unnest(gaps[2:]) AS after,
         unnest(range(1, len(found) + 1)) AS i, len(found) AS n FROM p WHERE len(found) > 0
),
s AS (
  SELECT *, map_extract(MAP {{{lengths}}}, left(m, 2))[1] AS wide,
         CAST(sum(length(before) + length(m)) OVER (PARTITION BY r, k ORDER BY i) - length(m) AS BIGINT) AS start FROM u
),
c AS (
  SELECT *, CASE WHEN k = {iban} AND m[5] = ' ' AND wide IS NOT NULL THEN left(m, CAST(wide + (wide - 1) // 4 AS INT)) ELSE m END AS x,
         translate(right(before, {REACH}) || chr(10) || left(after, {REACH}), '{_LOWER[0]}', '{_LOWER[1]}') AS around FROM s
),
b AS (
  SELECT *, CASE WHEN before = '' THEN start = 0 ELSE NOT regexp_matches(right(before, 1), '[A-Za-z0-9]') END AS free_left,
         CASE WHEN substr(m, length(x) + 1) || after = '' THEN i = n
              ELSE NOT regexp_matches(left(substr(m, length(x) + 1) || after, 1), '[A-Za-z0-9]') END AS free_right FROM c
),
signs AS (SELECT DISTINCT x, {signs} AS moved FROM b WHERE k = {iban}),
numbers AS (
  SELECT x, {number.format('moved')} AS digits FROM (SELECT x, moved, unnest(range(1, length(moved) + 1)) AS n FROM signs) GROUP BY x
),
rests AS (
  SELECT x, list_reduce(list_prepend(0, [CAST(digits[j] AS INT) FOR j IN range(1, length(digits) + 1)]), lambda a, z: (a * 10 + z) % 97) AS rest
  FROM numbers
),
j AS (SELECT b.*, rest FROM b LEFT JOIN rests ON b.k = {iban} AND b.x = rests.x),
f AS (SELECT r, k, x, start, {case('k', [text(k.name) for k in KINDS])} AS name FROM j WHERE coalesce({case('k', kept)}, false)),
g AS (
  SELECT r, {counts}, {listed.format(f' FILTER (k IN ({base}))')} AS base, {listed.format('')} AS spans FROM f GROUP BY r
)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


SQL = _sql()
