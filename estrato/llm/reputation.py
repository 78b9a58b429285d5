"""Host reputation: labelled page outcomes shrunk from suffix to registered domain to host.

A host's bad rate has a beta prior whose mean is the posterior mean of its registered
domain, that one's prior mean is the posterior mean of its suffix, and the suffix' prior
mean is the overall rate. A prior leaves out the labels of the group it is for, so that none
counts twice. The strength of each prior is fitted to all labelled hosts, domains or
suffixes by moments; where they do not tell it, the weakest is taken, and hosts without a
label of their own are allowed. A host is blocked when the lower bound of its posterior
exceeds a limit. Fixed allow and block rules come first.

Suffixes are the rules of a table (column `rule`, with `*.` and `!` as on publicsuffix.org);
where none fits, the last label is the suffix. User, port and a closing dot do not count for
domain and suffix, and an address (IPv4 or in brackets) is both whole.

A null url, or one without `://`, has an empty host and path; labels of such pages count
for nobody, and only a fixed rule can block them. A page without a label still belongs to
its host; pages with several labels count once for each; null labels are skipped.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from estrato.workspace import freeze

BOUND_Z = 1.645
MOST_BAD = 0.5

# The list of publicsuffix.org, as Debian packages it (MPL 2.0, see its head).
SUFFIX_LIST = Path(__file__).with_name("public_suffix_list.dat")


@dataclass(frozen=True)
class UrlRule:
    place: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.place.partition("/")
        return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)


RULES = (
    UrlRule("net/", "block"),
    UrlRule("example.net/en/", "allow"),
    UrlRule("example.com/de/", "block"),
    UrlRule("org/fr/", "allow"),
)


def with_place(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds the columns host and path, in place of columns of these names."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    after = F.substring(text, at + 3, F.length(text))
    host = F.regexp_extract(after, "^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({
        "host": F.when(at > 0, lower).otherwise(""),
        "path": F.when(at > 0, path).otherwise(""),
    })


def rule_of(rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    place, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.place)):
        fits = rule.fits(F.col("host"), F.col("path"))
        place = F.when(fits, rule.place).otherwise(place)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return place, verdict


def suffix_table(spark: SparkSession, path: Path = SUFFIX_LIST) -> DataFrame:
    """The rules of a public suffix list, names beyond ASCII also in the form of the DNS."""
    lines = (line.split() for line in path.read_text(encoding="utf-8").splitlines())
    rules = {line[0] for line in lines if line and not line[0].startswith("//")}
    rules |= {r.encode("idna").decode() for r in rules if not r.isascii()}
    whole = F.split(F.lit(" ".join(sorted(rules))), " ")
    return spark.range(1).select(F.explode(whole).alias("rule"))


def with_owner(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Adds suffix and registered domain of a host; one row per host."""
    body = F.regexp_replace("rule", r"^(\*\.|!)", "")
    labels = F.size(F.split("tail", r"\."))
    rules = freeze(suffixes.select("rule", body.alias("tail")).groupBy("tail").agg(
        F.max(F.when(~F.col("rule").rlike(r"^(\*\.|!)"), labels)).alias("plain"),
        F.max(F.when(F.col("rule").startswith("*."), labels + 1)).alias("wild"),
        F.max(F.when(F.col("rule").startswith("!"), labels - 1)).alias("except"),
    ), "suffixes")
    longest = rules.agg(F.max(labels)).first()[0] or 1
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), r":[0-9]*$", "")
    named = hosts.withColumn("name", F.regexp_replace(name, r"\.$", ""))
    size = F.size(F.split("name", r"\."))
    tails = named.select(
        "host", size.alias("size"), "name",
        F.explode(F.sequence(F.lit(1), F.least(size, F.lit(longest)))).alias("k"),
    ).withColumn("tail", F.expr("substring_index(name, '.', -k)"))
    found = tails.join(rules, "tail").groupBy("host").agg(
        F.max("except").alias("except"), F.max("plain").alias("plain"),
        F.max(F.when(F.col("wild") <= F.col("size"), F.col("wild"))).alias("wild"),
    ).select(
        "host", F.coalesce("except", F.greatest("plain", "wild")).alias("labels")
    )
    address = F.col("name").rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*\])$")
    owned = named.join(found, "host", "left").withColumn("labels", F.coalesce("labels", F.lit(1)))
    return owned.withColumns({
        column: F.when(address, F.col("name")).otherwise(
            F.expr(f"substring_index(name, '.', -labels - {more})")
        )
        for more, column in ((0, "suffix"), (1, "domain"))
    }).select(*hosts.columns, "suffix", "domain")


def prior(groups: DataFrame) -> Column:
    """Struct of the mean and the strength of a beta prior fitted to counts `bad` of `n`, and
    whether there was enough to fit the strength.

    It is kept between 1 and 99 pages, and is 1 where it cannot be fitted: one label alone
    never decides."""
    sums = groups.filter("n > 0").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("groups"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("rates"),
    )
    # Sum of n * (rate - mean)**2 against what binomial noise alone would give.
    mean = (F.col("bad") + 1) / (F.col("n") + 2)
    spread = F.col("rates") - 2 * F.col("mean") * F.col("bad") + F.col("n") * F.col("mean") ** 2
    noise = F.col("mean") * (1 - F.col("mean"))
    free = F.col("n") - F.try_divide("squares", "n") - (F.col("groups") - 1)
    share = F.when(free > 0, (spread - (F.col("groups") - 1) * noise) / (noise * free))
    share = F.least(F.greatest(F.coalesce(share, F.lit(0.5)), F.lit(0.01)), F.lit(0.5))
    fitted = sums.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in sums.columns]
    ).withColumn("mean", mean)
    fitted = fitted.withColumns({
        "strength": 1 / share - 1, "fitted": F.coalesce(free > 0, F.lit(False))
    })
    return fitted.select(F.struct("mean", "strength", "fitted")).scalar()


def _summed(groups: DataFrame, by: list[str]) -> DataFrame:
    return groups.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _rate(n: Column, bad: Column, mean: Column, strength: Column) -> Column:
    return (bad + strength * mean) / (n + strength)


def reputations(outcomes: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Bad rate of every host: posterior mean and lower bound, from rows (host, bad), where
    bad is 1, 0 or null for no label, and `known`: whether the host has labels or the
    strength of the prior of hosts is known. Without `suffixes`, the public list counts."""
    public = suffix_table(outcomes.sparkSession) if suffixes is None else suffixes
    hosts = freeze(with_owner(outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    ), public), "hosts")
    domains = _summed(hosts, ["domain", "suffix"])
    suffixes = _summed(domains, ["suffix"])
    top, middle, low = prior(suffixes), prior(domains), prior(hosts)

    def others(whole: str) -> list[Column]:
        """Counts of the larger group without the labels of the group itself."""
        return [F.col(f"{whole}_{c}") - F.col(c) for c in ("n", "bad")]

    above = suffixes.select(
        "suffix", F.col("n").alias("suffix_n"), F.col("bad").alias("suffix_bad")
    )
    domains = domains.join(above, "suffix").select(
        "domain", F.col("n").alias("domain_n"), F.col("bad").alias("domain_bad"),
        _rate(*others("suffix"), top["mean"], top["strength"]).alias("suffix_rate"),
    )
    rated = hosts.join(domains, "domain").withColumns({
        "domain_rate": _rate(*others("domain"), F.col("suffix_rate"), middle["strength"]),
        "weight": low["strength"], "known": (F.col("n") > 0) | low["fitted"],
    })
    rated = rated.withColumn(
        "rate", _rate(F.col("n"), F.col("bad"), F.col("domain_rate"), F.col("weight"))
    )
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("weight") + 1))
    bound = (F.col("rate") - BOUND_Z * spread).alias("bound")
    return rated.select("host", "n", "bad", "rate", bound, "known")


def judged(
    pages: DataFrame, labels: DataFrame, rules: tuple[UrlRule, ...] = RULES,
    most_bad: float = MOST_BAD, suffixes: DataFrame | None = None,
) -> DataFrame:
    """Pages with host, path, the fixed rule that fits and the verdict.

    `labels` has (page_id, bad). Columns of pages with the names of the added ones go.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    # The page's own columns travel in one, so that none can clash with those added here.
    places = with_place(pages).select(F.struct(*kept).alias("page"), "host", "path")
    marked = places.filter("host <> ''").select("page.page_id", "host").join(
        labels.select("page_id", "bad"), "page_id", "left"
    )
    bounds = reputations(marked, suffixes).select(
        "host",
        F.when(F.col("known") & (F.col("bound") > most_bad), "block").otherwise("allow").alias("earned"),
    )
    place, verdict = rule_of(rules)
    return places.join(bounds, "host", "left").select(
        *[F.col("page")[c].alias(c) for c in kept], "host", "path", place.alias("rule"),
        F.coalesce(verdict, "earned", F.lit("allow")).alias("verdict"),
    )
