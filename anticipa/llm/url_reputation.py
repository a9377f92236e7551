"""URL filters: explicit rules first, else the reputation of the host by empirical Bayes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anticipa.llm.common import ascii_lower
from anticipa.session import written

# Posterior bound: block when the share of bad pages is above the limit even `SIGMAS` deviations below its mean.
BAD_LIMIT, SIGMAS = 0.5, 2.0
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels. A public-suffix table would make this finer; none is bundled."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last that fits is the longest
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))).otherwise(found)
    return found


def _sums(children: DataFrame, group: list[str]) -> DataFrame:
    """Counts of every group, and what the spread of rates among its children is estimated from."""
    rate = F.col("bad") / F.col("pages")
    return children.groupBy(*group).agg(
        F.count("*").alias("k"), F.sum("pages").alias("pages"), F.sum("bad").alias("bad"),
        F.sum(F.col("pages") * F.col("pages")).alias("nn"), F.sum(F.col("bad") * rate).alias("br"),
    )


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the strength of a level's beta priors, by moments pooled over all groups of the level.

    A group of one child, or whose pages all have one outcome, says nothing of the spread among children; if there are no
    others, the prior is as weak as allowed.
    """
    m, n = F.col("bad") / F.col("pages"), F.col("pages")
    weight = n - F.col("nn") / n
    # Weighted spread of the rates between children, less what drawing `pages` of a fixed rate would give.
    extra = F.col("br") - n * m * m - (F.col("k") - 1) * m * (1 - m)
    sums = groups.where("k > 1").agg(
        F.sum(extra).alias("extra"), F.sum(weight * m * (1 - m)).alias("within")
    )
    fitted = F.when(F.coalesce(F.col("within"), F.lit(0.0)) == 0, F.lit(LEAST_STRENGTH)).when(
        F.col("extra") > 0, F.col("within") / F.col("extra") - 1
    )
    bounded = F.least(F.greatest(F.coalesce(fitted, F.lit(MOST_STRENGTH)), F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))
    return sums.select(bounded.alias("_strength"))


def _priors(own: DataFrame, above: DataFrame, key: list[str], strength: DataFrame) -> DataFrame:
    """`own` with `prior`: the rate of the rest of its group, shrunk towards the group's own prior."""
    group = above.select(*key, F.col("pages").alias("_pages"), F.col("bad").alias("_bad"), F.col("prior").alias("_prior"))
    joined = own.join(group, key).crossJoin(F.broadcast(strength))  # one row
    prior = (F.col("_bad") - F.col("bad") + F.col("_strength") * F.col("_prior")) / (
        F.col("_pages") - F.col("pages") + F.col("_strength")
    )
    return joined.withColumn("prior", prior).drop("_pages", "_bad", "_prior", "_strength")


def host_reputation(labelled: DataFrame) -> DataFrame:
    """Reputation of every host of `labelled` (host, bad 0/1): host, pages, bad, mean, bound.

    Page outcomes are counted per host, domain and suffix. A host's rate is shrunk towards the rate of the rest of its
    domain, that towards the rest of the suffix, and that towards all other suffixes; so no page counts twice. The strength
    of each level is fitted to the spread among the children of all its groups. `bound` is the posterior mean less `SIGMAS`
    posterior deviations. Rows without an outcome count as unlabelled.
    """
    hosts = written(
        labelled.where("bad IS NOT NULL").groupBy("host").agg(F.count("*").alias("pages"), F.sum("bad").alias("bad"))
        .withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix_of(F.col("host"))}),
        "hosts",
    )
    domains = _sums(hosts, ["domain", "suffix"])
    suffixes = _sums(domains, ["suffix"])
    root = _sums(suffixes, [])
    whole = root.select(F.col("pages").alias("_pages"), F.col("bad").alias("_bad"))
    rest = (F.col("_bad") - F.col("bad") + 1) / (F.col("_pages") - F.col("pages") + 2)
    above = suffixes.crossJoin(F.broadcast(whole)).withColumn("prior", rest)  # one row
    above = _priors(domains, above, ["suffix"], _strength(root))
    above = _priors(hosts, above, ["domain", "suffix"], _strength(suffixes))
    weight = F.col("pages") + F.col("_strength")
    mean = (F.col("bad") + F.col("_strength") * F.col("prior")) / weight
    judged = above.crossJoin(F.broadcast(_strength(domains))).withColumns({"mean": mean, "_weight": weight})  # one row
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("_weight") + 1))
    return judged.select("host", "pages", "bad", "mean", (F.col("mean") - SIGMAS * deviation).alias("bound"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES) -> DataFrame:
    """Verdict for every row of `pages` (page_id, url): page_id, host, path, rule, verdict.

    `outcomes` (page_id, bad 0/1) labels some pages; several rows of a page are outcomes each, null ones none. A rule
    decides if one fits; otherwise a host whose `bound` is over `BAD_LIMIT` is blocked, and every other host, also one
    without labelled pages, is allowed. Null urls and urls without `://` have an empty host and path, and share
    the reputation of the empty host. Repeated rows are judged alike; no pages: no rows.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = outcomes.select(F.col("page_id").alias("_page"), "bad")
    reputation = host_reputation(parsed.join(known, F.col("page_id") == F.col("_page")).select("host", "bad"))
    blocked = reputation.where(F.col("bound") > BAD_LIMIT).select("host", F.lit(True).alias("blocked"))
    judged = parsed.withColumn("best", best_rule(F.col("host"), F.col("path"), rules)).join(blocked, "host", "left")
    by_host = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), by_host).alias("verdict"),
    )
