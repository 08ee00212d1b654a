"""URL filtering by mined rules: token combinations that labelled URLs show to be unwanted, matched by an inverted index.

Explicit rules decide first. The frequent combinations of URL tokens are counted size by size over the distinct token
sets, together with the label; those with enough support and confidence become rules. A rule is filed under its rarest token, so a
URL meets only rules of tokens that it has, and is checked for the others there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.llm.scratch import stored

MIN_SUPPORT, MIN_CONFIDENCE, MAX_TOKENS = 0.001, 0.9, 4
#: A rule needs so many blocked rows, however small the table: fewer are no evidence.
MIN_ROWS = 5
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty for null and without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), *_AZ)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def explicit_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, nulls if none does.

    A rule is a host, ``/`` and the start of a path; it fits its host and all subdomains. The rules are a
    list that someone wrote, so they stand in the plan; of equally long ones the first is taken.
    """
    found = []
    for verdict, rule in rules:
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        found.append((len(rule), F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))))
    found.sort(key=lambda x: -x[0])
    first = F.coalesce(*(x for _, x in found)) if found else F.lit(None).cast("struct<rule:string,verdict:string>")
    return first["rule"], first["verdict"]


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a URL: its host's labels by their place from the end, all parts of its path, the file's ending, all query names.

    Digits are ``0``, so that numbered pages have the same tokens.
    """
    plain = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    named = lambda kind: lambda x: F.concat(F.lit(kind), x)
    filled = lambda values: F.filter(values, lambda x: x != "")
    low = F.translate(plain(path), *_AZ)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.transform(F.reverse(F.split(plain(host), r"\.")), lambda x, i: F.when(x != "", F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x)))
    ending = F.filter(F.slice(F.split(low, r"\."), -1, 1), lambda x: ~x.contains("/"))
    tokens = F.concat(
        F.array_compact(labels),
        F.transform(F.transform(filled(F.split(low, "/")), lambda x: F.substring_index(x, ".", 1)), named("p:")),
        F.transform(ending, named("e:")),
        F.transform(F.transform(filled(F.split(query, "&")), lambda x: F.substring_index(x, "=", 1)), named("q:")),
    )
    return F.array_distinct(tokens)


def _combinations(rows: DataFrame, least: int, max_tokens: int) -> Iterator[DataFrame]:
    """``(tokens, n, bad)`` of all combinations of 1, 2, ... ``max_tokens`` tokens that ``least`` blocked rows hold, one stored table per size.

    ``rows (tokens, blocked)``; all tokens of all rows count, equal token sets once with their numbers of rows. A combination is
    made of a smaller one in the same row, and only of such as ``least`` blocked rows hold too. One that is always blocked is not
    extended: nothing is surer than it.
    """
    sets = rows.groupBy(F.array_sort(F.array_distinct("tokens")).alias("tokens")).agg(F.count("*").alias("n"), F.count_if("blocked").alias("bad"))
    sets = stored(sets.withColumn("set", F.monotonically_increasing_id()), "url-sets")

    def frequent(held: DataFrame) -> DataFrame:
        counts = held.groupBy("items").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where(F.col("bad") >= least)
        return stored(counts.withColumnRenamed("items", "tokens"), "url-combinations")

    single = sets.select("set", "n", "bad", F.explode("tokens").alias("token"))
    found = frequent(single.select(F.array("token").alias("items"), "n", "bad"))
    yield found
    open_tokens = found.where("bad < n").select(F.col("tokens")[0].alias("token"))
    kept = single.join(open_tokens, "token").groupBy("set", "n", "bad").agg(F.array_sort(F.collect_list("token")).alias("rest"))
    held = stored(kept.select("n", "bad", F.array().cast("array<string>").alias("items"), "rest"), "url-open-tokens")
    for size in range(1, max_tokens + 1):
        # each token behind the last one of the combination, with the tokens behind it
        held = held.select("n", "bad", "items", "rest", F.posexplode("rest").alias("at", "token"))
        held = held.select("n", "bad", F.concat("items", F.array("token")).alias("items"), F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"))
        if size == 1:
            continue
        found = frequent(held)
        if found.isEmpty():
            return
        yield found
        held = held.join(found.where("bad < n").select(F.col("tokens").alias("items")), "items", "left_semi")


def mined_rules(
    labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """``(tokens, confidence, support)`` of ``labelled (tokens, blocked)``.

    A rule has at most ``max_tokens`` tokens, at least ``min_support`` of all rows, ``min_rows`` of them and ``min_confidence`` of the rows
    with its tokens are blocked, and no rule of fewer tokens, all among its own, is as sure. All tokens of all rows
    count, however many a row has. A null
    label counts as not blocked. Rows without tokens take no part; no blocked row gives no rules.
    """
    empty = "tokens array<string>, confidence double, support double"
    rows = labelled.where(F.size("tokens") > 0).select("tokens", F.coalesce("blocked", F.lit(False)).alias("blocked"))
    if rows.where("blocked").isEmpty():
        return labelled.sparkSession.createDataFrame([], empty)
    total = rows.count()
    least = math.ceil(min(1.0, max(min_support, min_rows / total)) * total)
    found = reduce(DataFrame.unionByName, _combinations(rows, least, max_tokens))
    found = found.select("tokens", (F.col("bad") / F.col("n")).alias("confidence"), (F.col("bad") / F.lit(total)).alias("support"))
    found = stored(found.where(F.col("confidence") >= min_confidence), "url-rules")
    # every smaller antecedent of a rule, by name
    parts = found.select("tokens", "confidence", F.explode("tokens").alias("gone"))
    parts = parts.select("tokens", "confidence", F.array_remove("tokens", F.col("gone")).alias("part"))
    smaller = found.select(F.col("tokens").alias("part"), F.col("confidence").alias("sure"))
    beaten = parts.join(smaller, "part").where("sure >= confidence").select("tokens").distinct()
    return found.join(beaten, "tokens", "left_anti")


def matched(patterns: DataFrame, rules: DataFrame) -> DataFrame:
    """``(pattern, tokens)`` rows of ``patterns`` that hold all tokens of some rule: ``(pattern, confidence)``, the surest."""
    each = patterns.select("pattern", "tokens", F.explode("tokens").alias("token"))
    named = rules.select(F.monotonically_increasing_id().alias("rule"), "confidence", F.col("tokens").alias("all"))
    named = stored(named, "url-rule-list")
    uses = named.select("rule", F.explode("all").alias("token"))
    common = each.join(uses.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = uses.join(common, "token", "left").groupBy("rule").agg(F.min_by("token", F.coalesce("n", F.lit(0))).alias("token"))
    index = named.join(rarest, "rule")
    hits = each.join(index, "token").where(F.size(F.array_except("all", "tokens")) == 0)
    return hits.groupBy("pattern").agg(F.max("confidence").alias("confidence"))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], labels: DataFrame | None = None, *, id_col: str = "page_id", url_col: str = "url", **how
) -> DataFrame:
    """``(<id_col>, host, path, rule, verdict, confidence)``, a row for each row of ``pages``.

    ``rules``: ``(verdict, rule)``, see ``explicit_rule``. URLs that no rule fits are blocked if a mined rule matches, else
    allowed. Rules are mined from ``labels (url, blocked)``; without it from those ``pages`` that an explicit rule decides,
    blocked against allowed: a URL that none fits has no label and teaches nothing. Equal token sets are judged once.
    ``confidence`` is that of the surest mined rule, null if none matches. Null URLs have no tokens and are allowed.
    """
    host, path = host_and_path(F.col("_url"))
    rule, verdict = explicit_rule(F.col("host"), F.col("path"), rules)
    urls = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))
    urls = urls.withColumns({"host": host, "path": path})
    urls = urls.select(
        "_id", "host", "path", rule.alias("rule"), verdict.alias("fixed"), url_tokens(F.col("host"), F.col("path"), F.col("_url")).alias("tokens")
    ).withColumn("pattern", F.xxhash64("tokens"))
    if labels is None:
        labelled = urls.where("fixed IS NOT NULL").select("tokens", (F.col("fixed") == "block").alias("blocked"))
    else:
        known = labels.select(F.col("url").alias("_url"), F.coalesce("blocked", F.lit(False)).alias("blocked"))
        known = known.withColumns({"host": host, "path": path})
        labelled = known.select(url_tokens(F.col("host"), F.col("path"), F.col("_url")).alias("tokens"), "blocked")
    found = mined_rules(labelled, **how)
    patterns = urls.where("size(tokens) > 0").groupBy("pattern").agg(F.first("tokens").alias("tokens"))
    hits = matched(patterns, found)
    decided = F.coalesce("fixed", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return urls.join(hits, "pattern", "left").select(
        F.col("_id").alias(id_col), "host", "path", "rule", decided.alias("verdict"), "confidence"
    )
