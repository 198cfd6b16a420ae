"""URL verdicts: rules by host and path, else gradient-boosted trees on lexical features, learned from what the rules label."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from matchlytics.llm.common import fresh, stored

Rule = tuple[str, str, str]
FEATURES = ["size", "host_size", "depth", "labels", "digits", "entropy", "parameters", "dashes", "suffix_size", "suffix_count", "suffix_blocked"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule], what: int) -> Column:
    """The rule (what=1 and 2: host and path joined; 0: its verdict) of the longest fitting one, or null."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in longest]
    return F.coalesce(*(F.when(fit, F.lit(r[0] if what == 0 else r[1] + r[2])) for fit, r in zip(fits, longest)), F.lit(None).cast("string"))


def _entropy(text: Column) -> Column:
    """Bits for each character."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda s, c: F.when(c == "", s).otherwise(s - share(c) * F.log2(share(c))))


def lexical(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Adds ``suffix`` and the features that a url alone has."""
    u = F.coalesce(url, F.lit(""))
    count = lambda c, chars: F.length(c) - F.length(F.translate(c, chars, ""))
    return df.withColumns(
        {
            "suffix": F.substring_index(host, ".", -1),
            "size": F.length(u).cast("double"),
            "host_size": F.length(host).cast("double"),
            "depth": count(F.col(path), "/").cast("double"),
            "labels": count(F.col(host), ".").cast("double"),
            "digits": (count(u, "0123456789") / F.greatest(F.length(u), F.lit(1))).cast("double"),
            "entropy": F.when(F.length(u) > 0, _entropy(u)).otherwise(0.0),
            "parameters": count(F.substring_index(u, "?", -1), "=").cast("double"),
            "dashes": count(u, "-_").cast("double"),
            "suffix_size": F.length(F.substring_index(host, ".", -1)).cast("double"),
        }
    )


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url", trees: int = 10, depth: int = 4, max_rows: int = 500_000, seed: int = 7) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict`` and ``features`` (an array in the order of FEATURES).

    ``rules`` are (allow or block, host, path): one fits its host and all subdomains if the path starts with its own; the
    longest wins. Urls that a rule labels train the trees, at most about ``max_rows`` of them, chosen by hash; the trees
    decide on all others. Statistics of suffixes (last host labels) cover all urls. A suffix is joined by key, one row a
    suffix. If the rules label nothing, or all alike, that (or allow) is the verdict without trees. Null urls have
    empty parts and features of an empty text. Existing columns of the added names are replaced.
    """
    pages = pages.drop(*(c for c in ("host", "path", "rule", "verdict", "features") if c != url))
    own = fresh("_row", pages.columns)
    rows = pages.select(F.struct(*pages.columns).alias(own), F.col(url).alias("_url")).withColumns({"host": host_of("_url"), "path": path_of("_url")})
    h, p = F.col("host"), F.col("path")
    rows = rows.withColumns({"rule": rule_of(h, p, rules, 1), "by_rule": rule_of(h, p, rules, 0)})
    rows = lexical(rows, "_url", "host", "path").withColumn("label", (F.col("by_rule") == "block").cast("double"))
    suffixes = stored(
        rows.groupBy("suffix").agg(
            F.log1p(F.count("*")).alias("suffix_count"),
            ((F.coalesce(F.sum("label"), F.lit(0.0)) + 1) / (F.count("label") + 2)).alias("suffix_blocked"),
            F.count("label").alias("n"),
            F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked"),
        )
    )
    total = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("blocked"), F.lit(0.0)).alias("blocked")).first()
    rows = rows.join(suffixes.select("suffix", "suffix_count", "suffix_blocked"), "suffix")
    if 0 < total.blocked < total.n:
        chosen = F.pmod(F.xxhash64("_url", F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, max_rows / total.n) * (1 << 30))
        train = stored(rows.where(F.col("label").isNotNull() & chosen).select("label", *FEATURES))
        model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=seed, checkpointInterval=-1, featuresCol="_v", predictionCol="_p")
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="_v", handleInvalid="keep")
        rows = PipelineModel([assemble, model.fit(assemble.transform(train).select("_v", "label"))]).transform(rows)
        guess = F.when(F.col("_p") > 0.5, "block").otherwise("allow")
    else:
        guess = F.lit("block" if total.n and total.blocked == total.n else "allow")
    return rows.select(f"{own}.*", "host", "path", "rule", F.coalesce("by_rule", guess).alias("verdict"), F.array(*FEATURES).alias("features"))
