"""URL filtering by given rules and by association rules mined from the URLs that the given rules label.

A given rule has a host, which also stands for all of its subdomains, and a path prefix; the longest that fits decides.
Where none fits, mined rules decide: Spark's FP-growth finds token combinations of host labels, path segments and
query names that come with a label often enough (``MIN_SUPPORT``) and surely enough (``MIN_CONFIDENCE``); a rule whose
part already says as much with as much confidence is pruned. Rules are matched by an inverted index: each is posted
under its rarest token, so a token set looks up its own tokens and checks only the rules posted there. All rules are
kept; mining, pruning and matching are joins in Spark.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and has no tokens, so gets
the default verdict, as does a URL that no mined rule matches; equal URLs are judged alike; without any labelled URL
there are no mined rules; an empty table gives no rows; other columns are kept, but for those named like the
results, which are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from closebook.llm.common import ascii_lower, store

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"
RESULTS = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    after = r"^(?:(?!://)[\s\S])*://([^/?#]*)([^?#]*)"
    host, path = F.regexp_extract(url, after, 1), F.regexp_extract(url, after, 2)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; nulls where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: host labels, path segments with digits as #, names in the query, and a mark for a fragment."""
    digits = lambda c: F.regexp_replace(c, "[0-9]+", "#")
    labels = F.transform(F.split(host, "[.]"), lambda x: F.concat(F.lit("h:"), digits(x)))
    steps = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), digits(x)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"[?]([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    every = F.array_distinct(F.concat(labels, steps, names))
    return F.filter(every, lambda x: ~x.isin("h:", "p:", "q:"))


@dataclass(frozen=True)
class Mined:
    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float


def pruned(rules: list[Mined]) -> list[Mined]:
    """Without rules that a part of theirs makes needless, best first: what ``mine`` does in Spark, for short lists."""
    kept: list[Mined] = []
    for rule in sorted(rules, key=lambda r: (len(r.tokens), r.tokens, r.verdict)):
        parts = (k for k in kept if k.verdict == rule.verdict and set(k.tokens) <= set(rule.tokens))
        if all(k.confidence < rule.confidence for k in parts):
            kept.append(rule)
    return sorted(kept, key=lambda r: (-r.confidence, -r.support, len(r.tokens), r.tokens, r.verdict))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules ``tokens, verdict, confidence, support`` from token sets to verdicts, from rows ``tokens, verdict``."""
    items = labelled.select(F.array_append("tokens", F.concat(F.lit("="), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    said = F.col("consequent")[0]
    # An antecedent never holds another verdict: a row has one.
    rules = model.associationRules.where(said.startswith("="))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), F.substring(said, 2, 1 << 30).alias("verdict"), "confidence", "support")
    rules = store(rules, "url-rules")
    # A rule whose part with one token fewer has its verdict as surely is never the best one that matches.
    parts = rules.where(F.size("tokens") > 1).withColumn("part", F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))))
    sure = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("sure"))
    needless = parts.join(sure, ["part", "verdict"]).where("sure >= confidence").select("tokens", "verdict").distinct()
    return store(rules.join(needless, ["tokens", "verdict"], "left_anti"), "url-rules")


def matched(found: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens, mined``: for those token sets (rows ``tokens``) that a rule fits, the verdict of the best such rule."""
    each = rules.select("*", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("often"))
    rarest = each.join(often, "token").groupBy("tokens", "verdict", "confidence", "support").agg(F.min(F.struct("often", "token")).alias("rarest"))
    # Best first: surest, most frequent, shortest.
    rank = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("tokens").alias("n"), F.col("tokens").alias("needs"), "verdict")
    posted = store(rarest.groupBy(F.col("rarest.token").alias("token")).agg(F.array_sort(F.collect_list(rank)).alias("rules")), "url-posted")
    sets = store(found.distinct(), "url-sets")
    looked = sets.select("tokens", F.explode("tokens").alias("token")).join(posted, "token")
    fits = F.filter("rules", lambda r: F.size(F.array_except(r["needs"], F.col("tokens"))) == 0)
    best = looked.select("tokens", F.get(fits, F.lit(0)).alias("best")).where("best is not null")
    return best.groupBy("tokens").agg(F.min("best").alias("best")).select("tokens", F.col("best.verdict").alias("mined"))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``."""
    keep = [c for c in pages.columns if c not in RESULTS]

    host, path = parsed(F.col(url))
    name, verdict = longest_rule(host, path, rules)
    found = tokens(host, path, F.col(url))
    labelled = store(pages.select(found.alias("tokens"), verdict.alias("verdict")).where("verdict is not null"), "url-labels")
    open_sets = pages.where(verdict.isNull()).select(found.alias("tokens"))
    mined = store(matched(open_sets, mine(labelled)), "url-mined").select(F.col("tokens").alias("_tokens"), F.col("mined").alias("_mined"))
    best = F.coalesce(verdict, F.col("_mined"), F.lit(default))
    # Only pages that no given rule judges look for a mined one.
    judged = pages.withColumn("_found", F.when(verdict.isNull(), found)).join(mined, F.col("_found") == F.col("_tokens"), "left")
    return judged.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"), name.alias("rule"), best.alias("verdict"))
