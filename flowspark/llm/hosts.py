"""URL filter by host reputation: rules first, then empirical-Bayes posteriors.

Outcomes of pages, given by id or judged from the pages' own text, are counted by host. Beta-binomial priors pass down
from all pages to public suffix, registered domain and host: each level's prior
has the mean of its parent's posterior and a strength estimated from how much the
level's rates vary (method of moments). A host is allowed where the lower bound
of its posterior reaches the threshold; hosts without labels fall back on their
domain's or suffix's posterior.

Pages are counted by host before anything meets, so a host with a third of all
pages costs one row per task. The one join of pages is against the host table.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import WORDS, without
from flowspark.session import cut_lineage

#: (verdict, rule): host, then the start of the path. Fixed by the task.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Elements of a page that are not its text, and the marks that junk is full of.
ASIDE = ("head", "script", "style", "nav", "header", "footer", "aside")
MARKS = "#*$%&|<>"
#: Fewest words of a good page, and most marks for a hundred words.
LEAST_WORDS, MOST_MARKS = 50, 20
OUTPUT = ["host", "path", "rule", "verdict", "bound"]


def host_of(url: str = "url") -> Column:
    """Host of a URL, A-Z lower-cased: what lies between ``://`` and the path; '' without ``://``."""
    raw = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: str = "url") -> Column:
    """Path of a URL, without query and fragment; '' without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")


def page_text(html: str = "html") -> Column:
    """Text of a page: without comments, the elements ``ASIDE`` and tags; an escaped mark is one."""
    text = F.regexp_replace(F.col(html), r"(?s)<!--.*?-->", " ")
    for name in ASIDE:
        text = F.regexp_replace(text, rf"(?s)<{name}[ >].*?</{name}>", " ")
    return F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"&(amp|lt|gt);", "&")


def with_outcome(pages: DataFrame, name: str, html: str = "html") -> DataFrame:
    """``pages`` with the outcome of each page: whether its text has at least ``LEAST_WORDS`` words, at most
    ``MOST_MARKS`` marks for a hundred words, and fewer than half of its windows of three words are repeats of
    others. A page without html has none (null)."""
    words = F.regexp_extract_all("__page_text", F.lit(WORDS), 0)
    n, at = F.size("__page_words"), F.arrays_zip(
        F.col("__page_words").alias("a"), F.expr("slice(__page_words, 2, greatest(size(__page_words), 1))").alias("b"),
        F.expr("slice(__page_words, 3, greatest(size(__page_words), 1))").alias("c"),
    )
    windows = F.transform(F.slice(at, 1, F.greatest(n - 2, F.lit(0))), lambda x: F.concat_ws(" ", x["a"], x["b"], x["c"]))
    marks = F.length("__page_text") - F.length(F.translate("__page_text", MARKS, ""))
    kept = [F.col(f"`{c}`") for c in pages.columns]
    texts = pages.select(*kept, page_text(html).alias("__page_text"))
    counted = texts.select(*kept, words.alias("__page_words"), marks.alias("__page_marks"))
    good = (n >= LEAST_WORDS) & (100 * F.col("__page_marks") <= MOST_MARKS * n) & (
        2 * F.size(F.array_distinct(windows)) > F.greatest(n - 2, F.lit(0))
    )
    return counted.select(*kept, F.when(F.col("__page_words").isNotNull(), good).alias(name))


def registered_parts(host: Column, long_suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """(registered domain, suffix). The suffix is the last label, or one of
    ``long_suffixes`` (such as ``co.uk``); the domain has one label more."""
    last, two = F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)
    if not long_suffixes:
        return two, last
    long = two.isin(*long_suffixes)
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(two), F.when(long, two).otherwise(last)


def matched_rule(host: str, path: str, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null without one."""
    found: Column | None = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, _, start = rule.partition("/")
        fits = ((F.col(host) == domain) | F.col(host).endswith("." + domain)) & F.col(path).startswith("/" + start)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if found is None else found


def _strength(level: DataFrame) -> float:
    """Strength of the beta prior of a level with rows (good, n, prior), between 1 and 1000.

    rho = (sum n (p - m)^2 - sum m (1 - m)) / sum (n - 1) m (1 - m); strength = 1 / rho - 1.
    """
    m, n, good = F.col("prior"), F.col("n"), F.col("good")
    v = m * (1 - m)
    over, base = level.filter("n > 0").agg(
        F.sum(n * (good / n - m) * (good / n - m) - v), F.sum((n - 1) * v)
    ).first()
    rho = over / base if base else 0.0
    return min(1000.0, max(1.0, 1 / rho - 1 if rho > 0 else 1000.0))


def reputation(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, bound) from (host, domain, suffix, good, n), one row per host.

    Only four sums per level come to the driver.
    """
    good, n = hosts.agg(F.sum("good"), F.sum("n")).first()
    mean = ((good or 0) + 1) / ((n or 0) + 2)
    posterior = lambda k: (F.col("prior") * k + F.col("good")) / (F.lit(k) + F.col("n"))
    parent = None
    for name in ("suffix", "domain", "host"):
        own = hosts.groupBy(*(["suffix", "domain", "host"][: ["suffix", "domain", "host"].index(name) + 1])).agg(
            F.sum("good").alias("good"), F.sum("n").alias("n")
        )
        if parent is None:
            own = own.withColumn("prior", F.lit(mean))
        else:
            own = own.join(parent, list(parent.columns[:-1]))
        own = cut_lineage(own)
        k = _strength(own)
        keys = ["suffix", "domain", "host"][: ["suffix", "domain", "host"].index(name) + 1]
        if name == "host":
            rate = posterior(k)
            spread = F.sqrt(rate * (1 - rate) / (F.lit(k) + F.col("n") + 1))
            return own.select("host", (rate - F.lit(z) * spread).alias("bound"))
        parent = own.select(*keys, posterior(k).alias("prior"))
    raise AssertionError


def judge(
    pages: DataFrame, labels: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES, threshold: float = 0.6,
    z: float = 1.645, long_suffixes: Sequence[str] = (), url: str = "url", html: str = "html",
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and bound.

    Without ``labels`` each page's outcome is that of its own text (``with_outcome``), and no page is
    looked up anywhere. ``labels`` holds (page_id, good); rows with a null in either count for nothing,
    repeated rows count each. Null URLs and such without ``://`` have empty host and
    path and share the reputation of the empty host. Without any labels the prior
    mean is one half, and the bound of every host is below it. Columns of pages named as
    the results are replaced.
    """
    base = without(pages, OUTPUT)
    with_host = base.withColumns({"host": host_of(url), "path": path_of(url)})
    domain, suffix = registered_parts(F.col("host"), long_suffixes)
    if labels is None:
        judged = with_outcome(base.select(host_of(url).alias("host"), F.col(f"`{html}`").alias("html")), "ok")
        rows = judged.select("host", F.col("ok").cast("long").alias("good"), F.when(F.col("ok").isNotNull(), 1).cast("long").alias("n"))
    else:
        outcomes = labels.filter("page_id IS NOT NULL AND good IS NOT NULL").groupBy("page_id").agg(
            F.sum(F.col("good").cast("long")).alias("good"), F.count("*").alias("n")
        )
        rows = base.select("page_id", host_of(url).alias("host")).join(outcomes, "page_id", "left")
    hosts = cut_lineage(
        rows.groupBy("host").agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        .withColumns({"domain": domain, "suffix": suffix})
    )
    bounds = cut_lineage(reputation(hosts, z))
    by_rule = matched_rule("host", "path", rules)
    by_host = F.when(F.col("bound") >= threshold, "allow").otherwise("block")
    return with_host.join(bounds, "host", "left").withColumn("__rule", by_rule).select(
        *[F.col(f"`{c}`") for c in base.columns], "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), by_host).alias("verdict"), "bound",
    )
