"""How far the sources of a language differ in their use of terms, and which terms make the difference.

Late string materialization: texts are cut into terms and counted within a task, many texts at once by sorting, and the
counts of many such parts are added up before they are put out; what is shuffled for counting is a digest of fixed width. A term's string is written once a task beside the counts and read again only for digests that
are kept: their least and greatest string tell whether two terms share a digest. Such digests are split, that is
counted again by their strings. Terms get their text back at the end, for the rows that are put out.

Sums over all kept terms of a pair of sources come from the terms that occur: with ``z`` for the difference of terms
that occur in neither, each occurring term adds what it differs from ``z``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm import common
from tableferry.llm.language_model import grouped

#: A language keeps terms of at least so many of its documents.
LEAST_DOCS = 30
#: What is added to each count, the parts that a share is told in, and the ranks of terms that are put out.
ADDED, PARTS, TOP = 5, 1_000_000_000, 50
#: Bytes whose counts a task holds until it adds them up, bytes of text that it counts at once, rows that it puts out at once.
HELD, CUT, ROWS = 1 << 25, 1 << 22, 100_000
#: Strings that a task remembers to have written.
SEEN = 500_000
#: Rows that a task of the pairs should make.
PAIR_ROWS = 2_000_000

#: Bytes of a term stay, A-Z in lower case; all other ASCII characters separate terms.
_LETTERS = bytes(b if b >= 128 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
_GROUP = ["lang", "source"]
_TERM = ["digest", "split"]
_SCHEMA = "lang string, source string, digest long, occurs long, docs long, term string"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a batch, and where each text's terms begin and end among them."""
    low = pc.ascii_lower(texts)  # its offsets start at 0
    _, offsets, data = low.buffers()
    letters = pa.py_buffer(data.to_pybytes().translate(_LETTERS) if data else b"")
    spaced = pa.StringArray.from_buffers(len(low), offsets, letters)
    lists = pc.ascii_split_whitespace(spaced.cast(pa.large_string()))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # a space at an end leaves an empty term
    return flat.filter(pa.array(full)), np.append(0, np.cumsum(full))[offsets]


def starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs. ``keys`` is used up."""
    keys.sort()
    firsts = starts(keys)
    return keys[firsts], np.diff(firsts, append=len(keys))


def tally(docs: DataFrame, digest_bits: int = 64, split: bool = False) -> DataFrame:
    """Counts by group and digest, folded over the texts that a task holds, and the strings behind the digests.

    Three kinds of rows: one with a null digest for each group; counts; and with ``term`` the string of a digest. With
    ``split`` each row of counts has its string. Strings are written anew when a task has written many of them.
    """

    def rows(n: int, lang=None, source=None, digest=None, occurs=None, docs=None, term=None) -> pa.RecordBatch:
        texts = [pa.nulls(n, pa.string()) if x is None else x.cast(pa.string()) for x in (lang, source, term)]
        numbers = [np.zeros(n, np.int64) if x is None else x for x in (occurs, docs)]
        found = pa.nulls(n, pa.int64()) if digest is None else pa.array(digest)
        columns = [texts[0], texts[1], found, pa.array(numbers[0]), pa.array(numbers[1]), texts[2]]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "digest", "occurs", "docs", "term"])

    def digests(words: pa.Array) -> np.ndarray:
        terms = (x for i in range(0, len(words), ROWS) for x in words.slice(i, ROWS).cast(pa.large_binary()).to_pylist())
        found = np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(words))
        return (found >> np.uint64(64 - digest_bits)).view(np.int64)

    def counted(part: pa.RecordBatch, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Term, group, occurrences and texts of each count of a part."""
        flat, offsets = terms_of(part.column(2))
        coded = flat.dictionary_encode()
        codes, width = coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
        text = np.repeat(np.arange(part.num_rows), np.diff(offsets))
        found, occurs = runs(group[text] * width + codes)
        text, code = np.divmod(runs(text * width + codes)[0], width)  # each term of a text once
        docs = runs(group[text] * width + code)[1]
        at, code = np.divmod(found, width)
        term = pa.DictionaryArray.from_arrays(pa.array(code.astype(np.int32)), coded.dictionary)
        return term, *(x.astype(np.int32) for x in (at, occurs, docs))

    def added(parts: list[tuple]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All terms of the parts; group, term, occurrences and texts of each count, those of equal group and term as one. ``parts`` is emptied."""
        term, at, occurs, docs = zip(*parts)
        parts.clear()
        chunks = pa.chunked_array(term).unify_dictionaries().chunks
        words, at, occurs, docs = chunks[0].dictionary, *map(np.concatenate, (at, occurs, docs))
        width = max(1, len(words))
        keys = at * np.int64(width) + np.concatenate([x.indices.to_numpy() for x in chunks])
        order = np.argsort(keys)
        keys, firsts = keys[order], starts(keys[order])
        sums = (np.add.reduceat(x[order], firsts, dtype=np.int64) if len(x) else np.zeros(0, np.int64) for x in (occurs, docs))
        return words, *np.divmod(keys[firsts], width), *sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: set[tuple[str, str]] = set()
        seen = pa.array([], pa.large_string())
        counts: list[tuple] = []
        numbers: dict[tuple[str, str], int] = {}

        def put_out() -> Iterator[pa.RecordBatch]:
            nonlocal seen
            langs, sources = (pa.array([x[i] for x in numbers], pa.string()) for i in (0, 1))
            unseen = pa.array([i for x, i in numbers.items() if x not in groups], pa.int64())
            if len(groups) + len(unseen) > SEEN:
                groups.clear()
            groups.update(list(numbers)[:SEEN])
            yield rows(len(unseen), langs.take(unseen), sources.take(unseen))
            words, at, code, occurs, docs = added(counts)
            digest = digests(words)
            for i in range(0, len(at), ROWS):
                some, its = pa.array(at[i : i + ROWS]), code[i : i + ROWS]
                term = words.take(pa.array(its)) if split else None
                yield rows(len(its), langs.take(some), sources.take(some), digest[its], occurs[i : i + ROWS], docs[i : i + ROWS], term)
            if not split:
                new = pc.invert(pc.is_in(words, value_set=seen))
                digest, words = digest[new.to_numpy(zero_copy_only=False)], words.filter(new)
                seen = (words if len(seen) + len(words) > SEEN else pa.concat_arrays([seen, words])).slice(0, SEEN)
                for i in range(0, len(words), ROWS):
                    term = words.slice(i, ROWS)
                    yield rows(len(term), digest=digest[i : i + ROWS], term=term)
            numbers.clear()

        size = 0
        for part in grouped(batches, 2, CUT):
            pairs = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
            group = np.fromiter((numbers.setdefault(x, len(numbers)) for x in pairs), np.int64, part.num_rows)
            counts.append(counted(part, group))
            size += part.nbytes
            del part  # its memory is free before the next batch comes
            if size >= HELD:
                yield from put_out()
                size = 0
        if counts:
            yield from put_out()

    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*_GROUP, "text")]
    return docs.select(*filled).mapInArrow(run, _SCHEMA)


def _counted(docs: DataFrame, digest_bits: int, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups; counts of kept terms (lang, source, digest, split, occurs, docs); the string of each digest and split."""
    tallied = common.stored(tally(docs, digest_bits), "tally")
    groups = common.stored(tallied.filter("digest IS NULL").select(*_GROUP).distinct(), "groups")
    sums = [F.sum("occurs").alias("occurs"), F.sum("docs").alias("docs")]
    counts = tallied.filter("occurs > 0").groupBy(*_GROUP, "digest").agg(*sums)
    counts = common.stored(counts, "counts").withColumn("split", F.lit(""))
    # Terms that share a digest have its documents together, so no kept term is missed.
    wide = common.stored(kept_terms(counts, least).select("digest").distinct(), "kept")
    strings = tallied.filter("term IS NOT NULL").select("digest", "term").join(wide, "digest", "left_semi")
    texts = common.stored(strings.groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last")), "texts")
    shared = texts.filter("term <> last").select("digest")
    names = texts.select("digest", F.lit("").alias("split"), "term")
    if not shared.isEmpty():
        apart = tally(docs, digest_bits, split=True).filter("occurs > 0").join(shared, "digest", "left_semi")
        apart = common.stored(apart.groupBy(*_GROUP, "digest", F.col("term").alias("split")).agg(*sums), "apart")
        counts = counts.join(shared, "digest", "left_anti").unionByName(apart)
        names = names.join(shared, "digest", "left_anti").unionByName(
            apart.select(*_TERM).distinct().select(*_TERM, F.col("split").alias("term"))
        )
    kept = kept_terms(counts, least)
    counts = counts.join(kept, ["lang", *_TERM], "left_semi")
    return groups, common.stored(counts, "terms"), names


def kept_terms(counts: DataFrame, least: int) -> DataFrame:
    return counts.groupBy("lang", *_TERM).agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).drop("docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(PARTS * (count + ADDED) / (total + ADDED * terms))`` in whole numbers."""
    wide = (count + ADDED).cast("decimal(20,0)") * F.lit(PARTS).cast("decimal(11,0)")
    below = (total + ADDED * terms).cast("decimal(20,0)")
    return F.when(below > 0, F.call_function("div", wide, below) + 1)


def _with_counted(left: DataFrame, right: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Inner join with the one row of each key; ``right`` counts its rows on the left in ``n_rows``."""
    return common.join_counted(left, right, keys, "n_rows", total).drop("n_rows")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, digest_bits: int = 64) -> DataFrame:
    """For each (lang, source): its distance from each other source of the language, and the terms it uses most beyond it.

    Rows: lang, source, part (``pair`` or ``term``), item, value, rank. A term is a run of letters, ASCII letters in lower
    case; a language keeps those of at least ``least`` of its documents. ``pair``: item is the other source, value the sum
    over all kept terms of the difference of the two shares. ``term``: item is a kept term of the group, value by how much
    its share exceeds the language's, ranks to ``top``. Shares are whole numbers of ``PARTS``. Ranks go by value, the
    greatest first, then by the bytes of the item.

    Null text, lang and source count as empty. Each row is a document, also where ids repeat or are null. A group without
    terms, or of a language without kept terms, has its pairs and no terms; a language of one source has no pairs. Texts
    are read whole. An empty table gives no rows. Other columns are ignored. ``digest_bits``: fewer only to provoke
    terms that share a digest.
    """
    groups, counts, names = _counted(docs, digest_bits, least)
    shares, groups = _shares(groups, counts)
    return _pairs(groups, shares).unionByName(_terms(shares, names, top))


def _shares(groups: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurring terms with the share ``p`` of their group and ``q`` of their language; groups with ``zero``, the share of others."""
    totals = counts.groupBy("lang", *_TERM).agg(F.sum("occurs").alias("in_lang"))
    by_lang = totals.groupBy("lang").agg(F.sum("in_lang").alias("lang_total"), F.count(F.lit(1)).alias("n_terms"))
    own = counts.groupBy(*_GROUP).agg(F.sum("occurs").alias("total"), F.count(F.lit(1)).alias("n_rows"))
    none = F.lit(0).cast("long")
    filled = {c: F.coalesce(c, none) for c in ("total", "n_rows", "lang_total", "n_terms")}
    # One row for each group of the table and each language: small beside the terms.
    groups = groups.join(own, _GROUP, "left").join(by_lang, "lang", "left").withColumns(filled)
    groups = common.stored(groups.withColumn("zero", F.coalesce(share(none, F.col("total"), F.col("n_terms")), none)), "sizes")
    placed = common.stored(counts.select(*_GROUP, *_TERM, "occurs").join(totals, ["lang", *_TERM]), "placed")
    sized = _with_counted(placed, groups.filter("n_rows > 0"), _GROUP, placed.count())
    p, q = share(F.col("occurs"), F.col("total"), F.col("n_terms")), share(F.col("in_lang"), F.col("lang_total"), F.col("n_terms"))
    shares = sized.select(*_GROUP, *_TERM, p.alias("p"), q.alias("q"), "zero")
    return common.stored(shares, "shares"), groups


def _terms(shares: DataFrame, names: DataFrame, top: int) -> DataFrame:
    more = shares.filter("p > q").select(*_GROUP, *_TERM, (F.col("p") - F.col("q")).alias("value"))
    by_value = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), *_TERM)
    # The least value among the first ranks, whatever the order of equal values; then all that reach it get their text.
    first = more.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    lowest = first.groupBy(*_GROUP).agg(F.min("value").alias("lowest"))
    more = common.stored(more, "more")
    n_rows = more.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n_rows"))
    reach = _with_counted(more, common.stored(lowest.join(n_rows, _GROUP), "lowest"), _GROUP, more.count())
    named = reach.filter("value >= lowest").join(names, _TERM)
    rank = F.row_number().over(Window.partitionBy(*_GROUP).orderBy(F.desc("value"), F.asc("term")))
    ranked = named.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select(*_GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The distance of each two sources of a language; a row for each ordered pair, which is what the result holds."""
    ours = shares.select("lang", *_TERM, F.col("source").alias("s"), F.col("p").alias("ps"), F.col("zero").alias("zs"))
    theirs = shares.select("lang", *_TERM, F.col("source").alias("o"), F.col("p").alias("po"), F.col("zero").alias("zo"))
    z = F.abs(F.col("zs") - F.col("zo"))
    both = ours.join(theirs, ["lang", *_TERM]).filter("s < o")
    in_both = F.abs(F.col("ps") - F.col("po")) - F.abs(F.col("ps") - F.col("zo")) - F.abs(F.col("po") - F.col("zs")) + z
    in_both = both.select("lang", "s", "o", in_both.alias("value"))

    # Terms of equal share differ equally from each source that lacks them: a row for each share.
    levels = common.stored(shares.groupBy(*_GROUP, "p", "zero").agg(F.count(F.lit(1)).alias("n")), "levels")
    # A source of a language meets all its others; slices of a language follow from the rows that this makes.
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("_sources"))
    rows = levels.groupBy("lang").agg(F.count(F.lit(1)).alias("_levels"))
    made = (F.coalesce("_levels", F.lit(0)) + F.col("_sources")) * F.col("_sources")
    slices = sources.join(rows, "lang", "left").select("lang", F.ceil(made / PAIR_ROWS).cast("int").alias("slices"))
    sized = common.stored(groups.join(slices, "lang"), "sliced")
    others = sized.select(
        "lang", F.col("source").alias("o"), F.col("zero").alias("zo"), "n_terms", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    )

    def dealt(frame: DataFrame, *columns: str) -> DataFrame:
        at = F.pmod(F.xxhash64(*columns), F.col("slices")).cast("int")
        return frame.withColumn("slice", at).drop("slices")

    one = levels.join(sized.select(*_GROUP, "slices"), _GROUP)
    one = dealt(one, "source", "p").withColumnsRenamed({"source": "s", "p": "ps", "zero": "zs"})
    one = one.join(others, ["lang", "slice"]).filter("s <> o")
    one = one.select("lang", F.least("s", "o").alias("s"), F.greatest("s", "o").alias("o"), (F.col("n") * (F.abs(F.col("ps") - F.col("zo")) - z)).alias("value"))
    every = dealt(sized.select(*_GROUP, "zero", "slices"), "source").withColumnsRenamed({"source": "s", "zero": "zs"})
    every = every.join(others, ["lang", "slice"]).filter("s < o").select("lang", "s", "o", (F.col("n_terms") * z).alias("value"))

    sums = in_both.unionByName(one).unionByName(every).groupBy("lang", "s", "o").agg(F.sum("value").cast("long").alias("value"))
    sums = common.stored(sums, "distances")
    mirrored = sums.select("lang", F.col("s").alias("source"), F.col("o").alias("item"), "value").unionByName(
        sums.select("lang", F.col("o").alias("source"), F.col("s").alias("item"), "value")
    )
    rank = F.row_number().over(Window.partitionBy(*_GROUP).orderBy(F.desc("value"), F.asc("item")))
    return mirrored.select(*_GROUP, F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def sql(least: int = LEAST_DOCS, top: int = TOP) -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
),
kept AS (SELECT lang, term, count(*) AS occurs FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {least}),
v AS (SELECT lang, count(*) AS v, sum(occurs) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS occurs FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(occurs) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.occurs, 0) AS occurs,
         1 + {PARTS}::HUGEINT * (coalesce(c.occurs, 0) + {ADDED}) // (coalesce(n.n, 0) + {ADDED} * v.v) AS p,
         1 + {PARTS}::HUGEINT * (kept.occurs + {ADDED}) // (v.n + {ADDED} * v.v) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE occurs > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= {top}
"""


SQL = sql()
