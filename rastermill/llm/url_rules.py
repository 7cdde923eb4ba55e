"""URL filters: stated rules first, then rules mined from labelled URLs by FP-growth.

DataFrame functions and Spark's FP-growth only. A URL's tokens are its host's labels and trailing
domains, the words of its path (numbers included), its query's names and values and its scheme. Every labelled URL is a transaction of its
tokens. Mined rules `tokens -> bad` are kept if they reach the
confidence and support bounds and no rule on fewer tokens is as confident. A rule is posted under its
rarest token (inverted index); a URL that has this token is checked for the others.

Support bounds the number of frequent items, and the kept rules are broadcast only while they are few
(RULES_BROADCAST); else they are joined by shuffle.

Cases: a null url or one without `://` has empty host and path and no tokens, and is allowed; equal
urls get equal verdicts; repeated rows are kept; labels that contradict each other for one id count as
the lower quality; without labels, or without both kinds, there are no mined rules; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SUPPORT = 0.0005
MIN_COUNT = 5
MIN_CONFIDENCE = 0.6
RULES_BROADCAST = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with its own; the longest wins.
STATED = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without `://`."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(path, r"[^\p{L}\p{N}]+"), lambda x: x != "")
    query = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)="), F.lit(1))
    values = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+=[^&#]+)"), F.lit(1))
    n = F.size(labels)
    domains = F.when(n >= 2, F.transform(F.sequence(F.lit(2), n), lambda k: F.concat(F.lit("domain:"), F.concat_ws(".", F.slice(labels, n - k + 1, k))))).otherwise(F.array().cast("array<string>"))
    parts = [
        domains,
        F.transform(F.flatten(F.transform(labels, lambda x: F.split(x, "-"))), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(words, lambda x: F.concat(F.lit("path:"), F.lower(x))),
        F.transform(F.concat(query, values), lambda x: F.concat(F.lit("query:"), F.lower(x))),
        F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)))),
    ]
    return F.when(host != "", F.array_distinct(F.concat(*parts))).otherwise(F.array().cast("array<string>"))


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(RULES_BROADCAST + 1).count() <= RULES_BROADCAST else df


def hits(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows (their columns and items) with `tokens` of each rule that fits them, by inverted index.

    A rule is posted under its token that the fewest rows have; a row with this token is checked for the others.
    """
    from .shared import stored

    entry = rows.withColumn("_t", F.explode("items"))
    names = rules.select(F.explode("tokens").alias("_t")).distinct()
    often = entry.select("_t").join(_small(names), "_t", "left_semi").groupBy("_t").count()
    posted = rules.select("tokens", F.explode("tokens").alias("_t")).join(often, "_t").groupBy("tokens").agg(F.min_by("_t", F.struct("count", "_t")).alias("_t"), F.count("*").alias("_known"))
    posted = posted.where(F.col("_known") == F.size("tokens")).drop("_known")  # else a token occurs nowhere
    posted = stored(posted, "posted")
    return entry.join(_small(posted), "_t").where(F.size(F.array_except("tokens", "items")) == 0).drop("_t")


def same_rows(labelled: DataFrame, least: float) -> DataFrame:
    """(token, rep) of every token in at least `least` bad rows; rep is the first of the tokens that stand in the same rows.

    Tokens stand in the same rows if they have as many rows and the same two sums of 64-bit hashes of these rows' items.
    """
    wide = [F.xxhash64("items", F.lit(k)).cast("decimal(20,0)").alias(f"_h{k}") for k in (0, 1)]
    seen = labelled.select(F.explode("items").alias("token"), F.col("bad"), *wide)
    seen = seen.groupBy("token").agg(F.count("*").alias("_n"), F.count_if("bad").alias("_bad"), F.sum("_h0").alias("_s0"), F.sum("_h1").alias("_s1"))
    often = seen.where(F.col("_bad") >= least)
    firsts = often.groupBy("_n", "_s0", "_s1").agg(F.sort_array(F.collect_list("token")).alias("_all"))  # tokens of one row at least
    return firsts.select(F.explode("_all").alias("token"), F.col("_all")[0].alias("rep"))


def spread(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """The rules with each token also replaced by every other token of the same rows."""
    members = classes.groupBy("rep").agg(F.collect_list("token").alias("_all"))
    parts = rules.select("*", F.explode("tokens").alias("rep")).join(members, "rep")
    parts = parts.groupBy("tokens", "confidence", "support").agg(F.collect_list("_all").alias("_all"))
    none = F.array(F.array().cast("array<string>"))
    every = F.aggregate("_all", none, lambda sets, more: F.flatten(F.transform(sets, lambda s: F.transform(more, lambda t: F.array_append(s, t)))))
    return parts.select(F.explode(every).alias("tokens"), "confidence", "support").withColumn("tokens", F.sort_array("tokens"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT, max_tokens: int | None = 3) -> DataFrame:
    """(tokens, confidence, support) of the kept rules; labelled has `items` and a boolean `bad`.

    A rule's support counts bad rows only, so its tokens are a frequent set of the bad rows: FP-growth
    runs over these, and confidence is counted over all rows. Rules have max_tokens tokens at most, or any number if it is None.

    A set with a token that the others imply in all rows (`domain:a.org` implies `host:org`) is as confident as
    without it, so it is never kept and need not be counted. Tokens that stand in the same rows are mined as one and put
    in each other's place at the end; other implied pairs are found among the sets of two.
    """
    from .shared import stored

    spark = labelled.sparkSession
    labelled = labelled.where(F.size("items") > 0).select("items", "bad").withColumn("_row", F.monotonically_increasing_id())
    labelled = stored(labelled, "transactions")  # this fixes the row numbers
    total, n_bad = labelled.agg(F.count("*"), F.count_if("bad")).first()
    least = max(min_support * total, min_count)
    none = spark.createDataFrame([], "tokens array<string>, confidence double, support double")
    if n_bad < least:
        return none
    classes = stored(same_rows(labelled, least), "classes")
    reps = classes.select(F.col("rep").alias("_t")).distinct()
    bad = labelled.where("bad").select("_row", F.explode("items").alias("_t")).join(_small(reps), "_t").groupBy("_row").agg(F.collect_list("_t").alias("items"))
    bad = stored(bad.select("items"), "bad")
    n_rows = bad.count()
    if n_rows < least:
        return none
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_rows).fit(bad)
    found = model.freqItemsets.where(F.col("freq") >= least)
    if max_tokens is not None:
        found = found.where(F.size("items") <= max_tokens)
    found = stored(found.select(F.sort_array("items").alias("tokens"), "freq"), "candidates")
    if found.isEmpty():
        return none
    few = F.size("tokens") <= 2
    counts = stored(hits(labelled, found.where(few)).groupBy("tokens").agg(F.count("*").alias("n")), "counts")
    single = counts.where(F.size("tokens") == 1).select(F.col("tokens")[0].alias("_t"), F.col("n").alias("_n"))
    pairs = counts.where(F.size("tokens") == 2).select("tokens", "n", F.explode("tokens").alias("_t"))
    implied = stored(pairs.join(single, "_t").where("n = _n").select("tokens").distinct(), "implied")
    known = found.withColumn("items", F.col("tokens")).withColumnRenamed("tokens", "_set")
    found = stored(found.join(hits(known, implied).select(F.col("_set").alias("tokens")).distinct(), "tokens", "left_anti"), "candidates")
    counts = counts.unionByName(hits(labelled, found.where(~few)).groupBy("tokens").agg(F.count("*").alias("n")))
    rules = found.join(counts, "tokens").select("tokens", (F.col("freq") / F.col("n")).alias("confidence"), (F.col("freq") / F.lit(total)).alias("support"))
    rules = stored(rules.where(F.col("confidence") >= min_confidence), "rules")
    if rules.isEmpty():
        return rules
    # A rule is pruned if dropping some of its tokens leaves a rule that is as confident. Every subset of a set
    # in found is there too, so the best confidence below a set comes from the sets with one token less.
    known = found.join(rules, "tokens", "left").select("tokens", F.coalesce("confidence", F.lit(0.0)).alias("own"))
    longest = rules.agg(F.max(F.size("tokens"))).first()[0]
    kept = rules.where(F.size("tokens") == 1)
    best = known.where(F.size("tokens") == 1).select("tokens", F.col("own").alias("best"))
    for size in range(2, longest + 1):
        less = known.where(F.size("tokens") == size).select("tokens", "own", F.explode(F.transform("tokens", lambda t: F.array_remove(F.col("tokens"), t))).alias("_less"))
        below = less.join(best.withColumnRenamed("tokens", "_less"), "_less").groupBy("tokens", "own").agg(F.max("best").alias("below"))
        below = stored(below, "below")
        kept = kept.unionByName(rules.join(below.where("own > below").select("tokens"), "tokens", "left_semi"))
        best = below.select("tokens", F.greatest("own", "below").alias("best"))
    return stored(spread(kept, classes), "rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url) of the distinct URLs in urls (url, items) that a mined rule fits."""
    return hits(urls, rules).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, stated: tuple = STATED) -> DataFrame:
    """page_id, host, path, rule and verdict of every page's URL; labels.doc_id names pages."""
    from .shared import stored as keep

    host, path = split_url(F.col("url"))
    split = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    items = tokens(F.col("url"), F.col("host"), F.col("path"))
    labelled = split.where("host <> ''").join(known.hint("merge"), F.col("page_id") == F.col("doc_id")).select(items.alias("items"), (F.col("quality") == 0).alias("bad"))
    rules = mine(labelled, max_tokens=None)
    longest = sorted(stated, key=lambda r: -len(r[1] + r[2]))
    fits = [((F.col("host") == h) | F.endswith(F.col("host"), F.lit("." + h))) & F.startswith(F.col("path"), F.lit(p)) for _, h, p in longest]
    rule = F.coalesce(*[F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, longest, strict=True)], F.lit(None).cast("string"))
    said = F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, longest, strict=True)], F.lit(None).cast("string"))
    out = split.withColumn("rule", rule).withColumn("_said", said)
    if rules.isEmpty():
        return out.select("page_id", "host", "path", "rule", F.coalesce("_said", F.lit("allow")).alias("verdict"))
    asked = out.where("_said IS NULL AND host <> ''").select("url", "host", "path").distinct().withColumn("items", items).select("url", "items")
    bad = matched(keep(asked, "urls"), rules).select(F.col("url").alias("_url"), F.lit("block").alias("_mined"))
    out = out.join(bad.hint("merge"), F.col("url") == F.col("_url"), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("_said", "_mined", F.lit("allow")).alias("verdict"))
