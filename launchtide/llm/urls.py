"""URL filters: host and path rules, and rules of URL tokens mined by FP-growth from labels.

Labelled URLs are baskets of tokens and a label. FP-growth finds the token sets that occur often
with a label; those that foretell it well enough become rules. Rules lie in an inverted index
under their rarest token: a URL's tokens look their rules up there, and a rule fits if
the URL has all of its tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from launchtide.llm.shared import broadcast_if_small, stored

# Verdict, host and path of the rules that come before all mined ones.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a basket's label looks like among its tokens, none of which begins so.
MARK = "="


def url_parts(url: str) -> tuple[Column, Column, Column]:
    """Host, path, and what follows the path; all empty for a null or a text without ``://``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*([\s\S]*)$", 1)


def suffixes(host: Column) -> Column:
    """A host and its parent domains, longest first: ``a.b.c, b.c, c``."""
    labels = F.split(host, r"\.", -1)
    every = F.transform(labels, lambda _, k: F.array_join(F.slice(labels, k + 1, F.size(labels) - k), "."))
    return F.when(host != "", every).otherwise(F.array().cast("array<string>"))


def url_tokens(host: Column, path: Column, tail: Column) -> Column:
    """The distinct tokens of a URL: domains, path segments, query keys and settings, fragment.

    Runs of digits in paths, settings and fragments are one ``#``, so numbered pages share tokens.
    """

    def plain(x: Column) -> Column:
        return F.regexp_replace(x, "[0-9]+", "#")

    def full(parts: Column) -> Column:
        return F.filter(parts, lambda x: x != "")

    segments = F.transform(full(F.split(path, "/", -1)), lambda x: F.concat(F.lit("path:"), plain(x)))
    settings = full(F.split(F.regexp_extract(tail, r"^\?([^#]*)", 1), "[&;]", -1))
    keys = F.transform(settings, lambda x: F.concat(F.lit("key:"), F.split_part(x, F.lit("="), F.lit(1))))
    whole = F.transform(settings, lambda x: F.concat(F.lit("query:"), plain(x)))
    fragment = F.transform(full(F.array(F.regexp_extract(tail, r"#([\s\S]*)$", 1))), lambda x: F.concat(F.lit("fragment:"), plain(x)))
    domains = F.transform(suffixes(host), lambda x: F.concat(F.lit("host:"), x))
    return F.array_distinct(F.concat(domains, segments, keys, whole, fragment))


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does.

    A rule fits its host and all subdomains, where the path begins with the rule's. Rules of
    equal length that both fit have the same host and path; the first listed counts.
    """
    longest = sorted(rules, key=lambda rule: -len(rule[1] + rule[2]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in longest]
    name = F.coalesce(*(F.when(fit, f"{h}{p}") for fit, (_, h, p) in zip(fits, longest)), F.lit(None).cast("string"))
    verdict = F.coalesce(*(F.when(fit, v) for fit, (v, _, _) in zip(fits, longest)), F.lit(None).cast("string"))
    return name, verdict


def _baskets(labelled: DataFrame, most_rows: int, most_tokens: int, min_rows: int, min_support: float) -> tuple[DataFrame, int, int]:
    """``items`` of a bounded sample of labelled URLs, their number, and the least support.

    A basket keeps its tokens of enough support that part the labels best, at most ``most_tokens``,
    and its label. Tokens that always occur together stand for one another: the one of least name stays.
    """
    host, path, tail = url_parts("url")
    rows = labelled.filter(F.col("label").isNotNull()).select("url", "label")
    n = rows.count()
    # Rows that are alike are told apart by their number, so one URL's rows are sampled as others are.
    if n > most_rows:
        turn = F.row_number().over(Window.partitionBy("url", "label", F.pmod(F.monotonically_increasing_id(), F.lit(64))).orderBy(F.lit(0)))
        rows = stored(rows.withColumn("turn", turn), "labelled")
        rows = rows.filter(F.pmod(F.xxhash64("url", "label", "turn"), F.lit(1 << 30)) < int(most_rows / n * (1 << 30)))
    rows = rows.select("label", url_tokens(host, path, tail).alias("tokens")).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "labelled")
    n = rows.count()
    least = max(min_rows, int(min_support * n) + 1)
    each = rows.select("row", "label", F.explode("tokens").alias("token"))
    mark = F.pmod(F.xxhash64("row"), F.lit(1 << 40))
    counts = each.groupBy("token", "label").agg(F.count("*").alias("n"), F.sum(mark).alias("mark"), F.bit_xor(F.xxhash64("row")).alias("bits"))
    totals = rows.groupBy("label").agg(F.count("*").alias("of"))
    shift = F.abs(F.log((F.col("n") / F.col("all")) / (F.col("of") / F.lit(max(n, 1)))))
    by_token = Window.partitionBy("token")
    useful = (
        counts.withColumn("all", F.sum("n").over(by_token))
        .filter(F.col("all") >= least)
        .join(broadcast_if_small(stored(totals, "totals")), "label")
        .withColumn("gain", shift * F.col("n"))
        .groupBy("token", "all")
        .agg(F.max("gain").alias("gain"), F.sum("mark").alias("mark"), F.bit_xor("bits").alias("bits"))
        # Equal counts and marks: the same rows.
        .groupBy("all", "mark", "bits")
        .agg(F.min(F.struct("token", "gain")).alias("least"))
        .select("least.token", "least.gain")
    )
    best = F.slice(F.sort_array(F.collect_list(F.struct(-F.col("gain"), "token"))), 1, most_tokens)
    baskets = (
        each.join(broadcast_if_small(stored(useful, "tokens")), "token")
        .groupBy("row", "label")
        .agg(best.alias("best"))
        .select(F.array_append(F.col("best.token"), F.concat(F.lit(MARK), "label")).alias("items"))
    )
    return stored(baskets, "baskets"), n, least


def mine_url_rules(
    labelled: DataFrame,
    *,
    min_support: float = 0.001,
    min_rows: int = 20,
    min_confidence: float = 0.6,
    min_lift: float = 1.2,
    most_rows: int = 500_000,
    most_tokens: int = 12,
) -> DataFrame:
    """Rules ``tokens, label, support, confidence`` from labelled URLs, stored.

    ``labelled``: (url, label). Spark's FP-growth finds sets of tokens with a label. Such a set is
    a rule if it occurs in ``min_rows`` URLs and a share ``min_support`` of them, if its
    label has at least ``min_confidence`` among URLs with its tokens and ``min_lift`` times its share
    of all, and if no rule with one token less is as sure.

    Rules are fitted on about ``most_rows`` labelled rows at most, chosen by hash, and on the
    ``most_tokens`` tokens of each that shift its label's share most, so a URL of very many tokens
    has no more than ``2 ** most_tokens`` sets. Rows without a label are left out; a null URL
    has no tokens. No rows, no rules.
    """
    spark = labelled.sparkSession
    schema = "tokens array<string>, label string, support bigint, confidence double"
    baskets, n, least = _baskets(labelled, most_rows, most_tokens, min_rows, min_support)
    if baskets.isEmpty() or n < least:
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / n), minConfidence=0.0).fit(baskets)
    sets = stored(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    is_label = F.filter("items", lambda x: x.startswith(MARK))
    tokens = F.filter("items", lambda x: ~x.startswith(MARK))
    bare = sets.filter(F.size(is_label) == 0).select(F.col("items").alias("tokens"), F.col("freq").alias("of"))
    marked = sets.filter(F.size(is_label) == 1).select(tokens.alias("tokens"), is_label[0].alias("mark"), "freq")
    alone = marked.filter(F.size("tokens") == 0).select("mark", F.col("freq").alias("all"))
    rules = (
        marked.filter(F.size("tokens") > 0)
        .join(bare, "tokens")
        .join(broadcast_if_small(alone), "mark")
        .withColumn("confidence", F.col("freq") / F.col("of"))
        .filter((F.col("confidence") >= min_confidence) & (F.col("confidence") >= min_lift * F.col("all") / n))
        .select("tokens", F.substring("mark", 2, 1 << 30).alias("label"), F.col("freq").alias("support"), "confidence")
    )
    rules = stored(rules, "rules")
    fewer = rules.select("tokens", "label", F.col("confidence").alias("other"))
    dropped = F.explode(F.transform("tokens", lambda x: F.array_remove(F.col("tokens"), x))).alias("tokens")
    covered = (
        rules.select("label", "confidence", F.col("tokens").alias("whole"), dropped)
        .join(fewer, ["tokens", "label"])
        .filter("other >= confidence")
        .select(F.col("whole").alias("tokens"), "label")
        .distinct()
    )
    return stored(rules.join(covered, ["tokens", "label"], "left_anti").select("tokens", "label", "support", "confidence"), "rules")


def rule_index(rules: DataFrame) -> DataFrame:
    """The rules under their rarest token, as ``token, tokens, label, support, confidence``.

    Rarest is the token that the fewest rules hold; of several, the least.
    """
    each = rules.select("*", F.explode("tokens").alias("token"))
    held = each.groupBy("token").agg(F.count("*").alias("held"))
    rarest = (
        each.join(broadcast_if_small(held), "token")
        .groupBy("tokens", "label", "support", "confidence")
        .agg(F.min(F.struct("held", "token")).alias("rarest"))
    )
    return stored(rarest.select("rarest.token", "tokens", "label", "support", "confidence"), "index")


def judge_urls(
    pages: DataFrame,
    mined: DataFrame,
    *,
    rules: Sequence[tuple[str, str, str]] = RULES,
    default: str = "allow",
) -> DataFrame:
    """Every URL's verdict: ``page_id, host, path, rule, verdict, tokens, confidence``.

    ``pages``: (page_id, url); ``mined``: rules of :func:`mine_url_rules`, whose labels are
    verdicts; ``rules``: (verdict, host, path). The longest of ``rules`` that fits decides and
    is named in ``rule``. Otherwise the mined rule of greatest confidence whose tokens the URL has
    decides, of several that of greatest support, then of greatest label and tokens; it is in ``tokens`` and
    ``confidence``. Where none fits the verdict is ``default``.

    The host lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the
    path follows, up to ``?``, ``#`` or the end. A null URL, or one without ``://``, has neither. Each row
    of ``pages`` gives one row, also where page_ids repeat or are null. Other columns are not read.
    """
    host, path, tail = url_parts("url")
    name, verdict = first_rule(F.col("host"), F.col("path"), rules)
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), tail.alias("tail"))
    parts = parts.select("*", name.alias("rule"), verdict.alias("verdict"))
    none = [F.lit(None).cast("array<string>").alias("tokens"), F.lit(None).cast("double").alias("confidence")]
    ruled = parts.filter("rule is not null").select("page_id", "host", "path", "rule", "verdict", *none)
    rest = parts.filter("rule is null").withColumn("row", F.monotonically_increasing_id())
    rest = rest.withColumn("own", url_tokens(F.col("host"), F.col("path"), F.col("tail")))
    index = broadcast_if_small(rule_index(mined)).withColumnRenamed("token", "key")
    fits = (F.size(F.array_except("tokens", "own")) == 0) & F.col("key").isNotNull()
    best = F.max(F.when(fits, F.struct("confidence", "support", F.struct("label", "tokens").alias("rule"))))
    # The rows of a URL come from one task and are combined there, so each is one row in the shuffle.
    found = (
        rest.select("row", "page_id", "host", "path", "own", F.explode_outer("own").alias("key"))
        .join(index, "key", "left")
        .groupBy("row", "page_id", "host", "path")
        .agg(best.alias("best"))
    )
    return ruled.unionByName(
        found.select(
            "page_id",
            "host",
            "path",
            F.lit(None).cast("string").alias("rule"),
            F.coalesce("best.rule.label", F.lit(default)).alias("verdict"),
            "best.rule.tokens",
            "best.confidence",
        )
    )


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url, label`` of pages whose document is labelled: ``block`` if it is toxic or of bad quality.

    The number that ends a page's path, whatever suffix follows it, is its document's doc_id. A document
    that any of its labels finds toxic or bad is to be blocked; one with neither mark has no label.
    """
    _, path, _ = url_parts("url")
    number = F.regexp_extract(path, r"/([0-9]{1,18})(\.[A-Za-z]+)?/?$", 1)
    shown = pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id")).filter("doc_id is not null")
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(bad.alias("bad")).filter("bad is not null")
    return shown.join(marks, "doc_id").select("url", F.when(F.col("bad") == 1, "block").otherwise("allow").alias("label"))
