"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes are counted for each host, registered domain and suffix. At every level the spread of the rates
among siblings gives a beta prior by moments: a suffix is shrunk towards all pages, a domain towards its suffix, a host
towards its domain. A host is blocked if the lower posterior bound of its share of bad pages exceeds a limit, so that
a few bad pages alone never block a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rules of the query contract as (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: A page of fewer visible words is a bad outcome.
LEAST_WORDS = 50
#: Elements whose content is no visible text of a page.
UNSEEN = ("script", "style", "head", "nav", "footer")
#: Standard normal quantile of the bound (one-sided 97.5 %), the share of bad pages from which a host is blocked, and
#: the least and the greatest weight of a prior in pages.
QUANTILE = 1.96
LIMIT = 0.5
WEIGHTS = (2.0, 1000.0)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without one, and for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column) -> Column:
    """The last two labels of a host without its port."""
    return F.substring_index(F.substring_index(host, ":", 1), ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(F.substring_index(host, ":", 1), ".", -1)


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def visible_words(frame: DataFrame, html: Column) -> DataFrame:
    """``frame`` with ``words``: those of a page outside its tags, comments, and elements that show no text of its own.

    One pass over the pieces between ``<`` signs, so its time grows with the length of a page whatever is left open: an
    element or a comment is passed over only if it is closed further on.
    """

    def piece(text: Column, at: Column) -> Column:
        tag = F.regexp_extract(text, rf"(?i)^(/?(?:{'|'.join(UNSEEN)}))(?=[^a-z0-9_]|$)", 1)
        behind = F.when(F.contains(text, F.lit(">")) & (at > 0), F.substring_index(text, ">", -1)).otherwise(text)
        first = F.when(F.contains(text, F.lit(">")) & (at > 0), F.substr(text, F.instr(text, F.lit(">")) + 1)).otherwise(text)
        return F.struct(
            at.alias("at"),
            F.when(at > 0, F.lower(tag)).otherwise("").alias("tag"),
            (F.startswith(text, F.lit("!--")) & (at > 0)).alias("comment"),
            F.contains(text, F.lit("-->")).alias("ends"),
            _words(F.when(F.contains(text, F.lit("-->")), behind).otherwise(first)).alias("words"),
        )

    def last(found: Column) -> Column:
        """The greatest place at which something is true, or 0."""
        return F.coalesce(F.array_max(F.transform(F.filter("_pieces", lambda p: found_in(p, found)), lambda p: p["at"])), F.lit(0))

    def found_in(p: Column, name: Column) -> Column:
        return F.when(name == "!", p["ends"]).otherwise(p["tag"] == F.concat(F.lit("/"), name))

    def step(state: Column, p: Column) -> Column:
        inside = state["within"] != ""
        closes = inside & F.when(state["within"] == "!", p["ends"]).otherwise(p["tag"] == F.concat(F.lit("/"), state["within"]))
        starts = F.when(p["comment"] & ~p["ends"], "!").when(p["tag"].isin(*UNSEEN), p["tag"]).otherwise("")
        shut = F.coalesce(F.try_element_at(state["last"], starts), F.lit(-1)) > p["at"]
        within = F.when(inside & ~closes, state["within"]).when(~inside & shut, starts).otherwise("")
        words = state["words"] + F.when(within == "", p["words"]).otherwise(0)
        return F.struct(within.alias("within"), words.alias("words"), state["last"].alias("last"))

    pieces = F.transform(F.split(html, "<"), piece)
    marked = frame.withColumn("_pieces", pieces)
    places = [x for name in (*UNSEEN, "!") for x in (F.lit(name), last(F.lit(name)))]
    marked = marked.withColumn("_last", F.create_map(*places))
    # The places travel in the state: a column named within the steps would be worked out again in each of them.
    start = F.struct(F.lit("").alias("within"), F.lit(0).alias("words"), F.col("_last").alias("last"))
    return marked.withColumn("words", F.aggregate("_pieces", start, step, lambda s: s["words"])).drop("_pieces", "_last")


def outcomes(pages: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``host, bad`` (0 or 1) for each page: bad if its visible text has too few words. Null html counts as empty."""
    html = F.coalesce(F.col("html"), F.lit(""))
    counted = visible_words(pages.select(host_of(F.col("url")).alias("host"), html.alias("html")), F.col("html"))
    return counted.select("host", (F.col("words") < least_words).cast("long").alias("bad"))


def _prior(level: DataFrame, parents: list[str], rate: str) -> DataFrame:
    """Weight of the prior for the children of each parent: method of moments on the rates of siblings.

    With p the parent's rate, V the weighted spread of the children's rates and 1/h the mean of 1/n, the weight solves
    V = p(1-p) (1/h + 1/(1+w)); no spread beyond chance gives the greatest weight, a single child the least.
    """
    p = F.col("p")
    spread = F.sum(F.col("n") * (F.col("bad") / F.col("n") - F.col(rate)) ** 2) / F.sum("n")
    chance = F.count("*") / F.sum("n")
    found = level.groupBy(parents).agg(spread.alias("v"), chance.alias("c"), F.count("*").alias("k"), F.first(rate).alias("p"))
    beyond = F.col("v") / F.greatest(p * (1 - p), F.lit(1e-9)) - F.col("c")
    weight = F.when(F.col("k") < 2, WEIGHTS[0]).when(beyond <= 0, WEIGHTS[1]).otherwise(1 / F.greatest(beyond, F.lit(1e-9)) - 1)
    return found.select(*parents, F.greatest(F.lit(WEIGHTS[0]), F.least(F.lit(WEIGHTS[1]), weight)).alias("weight"))


def reputations(labelled: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """One row for each host of ``labelled`` (host, bad): n, bad, rate (posterior mean), low (posterior bound).

    Rows with a null host or outcome do not count; an empty table gives no rows. Pages are counted before the
    shuffle, so a host with a third of all pages is one row for each task; priors see one row for each host.
    """
    hosts = labelled.dropna(subset=["host", "bad"]).groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    every = suffixes.agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"))

    mean = (F.col("bad") + F.col("weight") * F.col("above")) / (F.col("n") + F.col("weight"))
    top = suffixes.crossJoin(F.broadcast(every)).withColumn("above", (F.col("all_bad") + 1) / (F.col("all_n") + 2))
    top = top.crossJoin(F.broadcast(_prior(top, [], "above"))).withColumn("suffix_rate", mean).select("suffix", "suffix_rate")
    middle = domains.join(top, "suffix")
    middle = middle.join(_prior(middle, ["suffix"], "suffix_rate"), "suffix").withColumn("above", F.col("suffix_rate"))
    middle = middle.select("suffix", "domain", mean.alias("domain_rate"))
    low = hosts.join(middle, ["suffix", "domain"])
    low = low.join(_prior(low, ["suffix", "domain"], "domain_rate"), ["suffix", "domain"]).withColumn("above", F.col("domain_rate"))
    a = F.col("bad") + F.col("weight") * F.col("above")
    b = F.col("n") - F.col("bad") + F.col("weight") * (1 - F.col("above"))
    deviation = F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    return low.select("host", "n", "bad", (a / (a + b)).alias("rate"), F.greatest(F.lit(0.0), a / (a + b) - quantile * deviation).alias("low"))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null. A rule fits its host and all subdomains."""
    found = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        at = rule.index("/")
        on_host = (host == rule[:at]) | host.endswith("." + rule[:at])
        result = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = on_host & path.startswith(rule[at:])
        found = F.when(fits, result) if found is None else found.when(fits, result)
    return found


def judge(pages: DataFrame, labelled: DataFrame | None = None, limit: float = LIMIT, rules=RULES) -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict and the host's posterior ``rate`` and ``low``.

    Rules come first. Else a page is blocked if the posterior bound of its host lies above ``limit``; a host without
    labelled pages is allowed. Null urls and urls without ``://`` have an empty host and path, whose pages share one
    reputation. Repeated rows are judged each; null ids stay; other columns are ignored.
    """
    known = reputations(outcomes(pages) if labelled is None else labelled)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    # One row for each host is joined to pages; a hot host is cut into slices by a salt that is copied on the small side.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SLICES)))
    copies = known.select("host", "n", "rate", "low").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)).cast("array<bigint>")))
    judged = salted.join(copies, ["host", "salt"], "left")
    own = F.when(F.coalesce("low", F.lit(0.0)) > limit, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), "rate", "low")


#: Slices of a host in the join of pages with reputations.
SLICES = 16
