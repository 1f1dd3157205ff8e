"""Quality of documents: a classifier's evidence shrunk towards their site by empirical Bayes.

A text's evidence is a naive Bayes sum over binned measures of its form: share of
letters, of capitals, of distinct words, of the commonest word, word and line length
and the like. A site's evidence is its share of good documents. A path with few
labelled documents is drawn towards its host, a host towards all documents, each by
a beta prior whose strength is fitted to how much sites differ. The two are added in
log odds, so a document without a telling text is judged by its path.

All of it is grouped sums over labelled documents, one row per host and path: hot
hosts shrink in the input tasks. Only expressions of the DataFrame API are used.

Defined results: NULL and empty texts fall into the bins of nothing. A NULL host or
path is one of its own. A document without labels around it gets the global share.
Without labels all get one half. Labels with a NULL quality are not learnt from;
several labels of a document count by their largest. Repeated rows are judged alike.
Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.texts import SPACE, whole
from turnstile.session import scratch_path

BINS = 16
EXTRA = 1.0  # pseudo-count of each bin
LEAST, MOST = 1.0, 1e4  # bounds of a prior's strength, in documents


def measured(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` and the measures of a text's form, each cut into BINS bins from 0."""
    split = docs.select(*keep, whole(text).alias("_text")).withColumn(
        "_words", F.filter(F.split("_text", SPACE), lambda w: w != "")
    )
    # a word beside the one before it; the array is a column here, so it is split once per text
    pairs = F.arrays_zip("_words", F.slice("_words", 2, F.size("_words")).alias("_next"))
    names = [c for c in split.columns if c != "_text"]
    size = F.greatest(F.length("_text"), F.lit(1))
    share = lambda pattern: F.length(F.regexp_replace("_text", pattern, "")) / size  # noqa: E731  of what is left

    def cut(part: Column) -> Column:
        return F.least(F.floor(part * BINS), F.lit(BINS - 1)).cast("int")

    shaped = split.select(
        *names,
        size.alias("_size"),
        F.greatest(F.size("_words"), F.lit(1)).alias("_count"),
        F.size(F.filter(pairs, lambda p: p["_words"] == p["_next"])).alias("_follows"),
        cut(share(r"[^\p{L}]+")).alias("letters"),
        cut(share(r"[^\p{Lu}]+") * 4).alias("capitals"),
        cut(share(r"[\p{L}\p{N}\s.,]+") * 4).alias("marks"),
    )
    count = F.col("_count")
    return shaped.select(
        *(c for c in names if c != "_words"),
        "letters",
        "capitals",
        "marks",
        cut(F.size(F.array_distinct("_words")) / count).alias("distinct"),
        cut(F.col("_follows") / count * 4).alias("repeats"),
        cut(F.col("_size") / count / 32).alias("word_length"),
        F.least(F.floor(F.log2(count)), F.lit(BINS - 1)).cast("int").alias("words"),
    )


MEASURES = ["letters", "capitals", "marks", "distinct", "repeats", "word_length", "words"]


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def evidence(rows: DataFrame, names: list[str]) -> dict[str, list[float]]:
    """Log odds of each measure's bins from labelled ``rows`` (good and the measures)."""
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("bin")) for n in names))).alias("p")
    counts = rows.select("good", pairs).groupBy("p.name", "p.bin").agg(
        F.sum("good").alias("good"), F.count(F.lit(1)).alias("n")
    )
    found = {(r["name"], r["bin"]): (r["good"], r["n"] - r["good"]) for r in counts.collect()}  # names x BINS at most
    table = {}
    for name in names:
        here = [found.get((name, b), (0, 0)) for b in range(BINS)]
        good, bad = (sum(x[k] for x in here) + EXTRA * BINS for k in (0, 1))
        table[name] = [math.log((g + EXTRA) / good) - math.log((b + EXTRA) / bad) for g, b in here]
    return table


def _strength(groups: DataFrame, parent: Column) -> Column:
    """Beta prior strength by moments: how far the groups' shares lie from their parents' beyond chance."""
    spread = parent * (1 - parent)
    over = F.sum(F.col("n") * ((F.col("good") / F.col("n") - parent) * (F.col("good") / F.col("n") - parent) - spread / F.col("n")))
    between = over / F.sum(F.col("n") * spread)  # share of the variance that is between groups
    bounded = F.least(F.greatest(1 / F.greatest(between, F.lit(1e-6)) - 1, F.lit(LEAST)), F.lit(MOST))
    return F.coalesce(bounded, F.lit(MOST))


def site_shares(labelled: DataFrame, hosts_of: DataFrame) -> DataFrame:
    """Posterior share of good documents for each (host, path) of ``hosts_of``, and the global share.

    ``labelled`` has host, path and good.
    """
    paths = _written(labelled.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n")), "paths")
    overall = paths.agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("g")).select(F.coalesce("g", F.lit(0.5)).alias("g"))
    share = overall.first()["g"]
    hosts = _written(paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "hosts")
    alpha = hosts.agg(_strength(hosts, F.lit(share)).alias("a")).first()["a"]
    hosts = hosts.select(F.col("host").alias("_host"), ((F.col("good") + alpha * share) / (F.col("n") + alpha)).alias("host_share"))
    known = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    beta = known.agg(_strength(known, F.col("host_share")).alias("b")).first()["b"]
    seen = paths.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "good", "n")
    every = hosts_of.select("host", "path").distinct()
    joined = every.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left").join(
        seen, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")), "left"
    )
    host_share = F.coalesce("host_share", F.lit(share))
    good, n = F.coalesce("good", F.lit(0)), F.coalesce("n", F.lit(0))
    return joined.select(
        "host",
        "path",
        host_share.alias("host_share"),
        ((good + beta * host_share) / (n + beta)).alias("path_share"),
        F.lit(share).alias("all_share"),
    )


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, held_out: int = 5) -> DataFrame:
    """doc_id, held_out, host and path shares, score and prediction of every document.

    Labels of documents whose crc32(doc_id as text) is divisible by ``held_out`` are not learnt from.
    """
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % held_out == 0, F.lit(False))
    names = MEASURES
    keep = [F.col("doc_id"), out.alias("held_out"), host.alias("host"), path.alias("path")]
    rows = _written(measured(docs, F.col("text"), keep), "measures")
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("good"))
    labelled = _written(rows.where("not held_out").join(known, "doc_id"), "labelled")
    table = evidence(labelled, names)
    shares = _written(site_shares(labelled, rows), "site-shares")
    shares = shares.withColumnRenamed("host", "_host").withColumnRenamed("path", "_path")
    told = sum((F.get(F.array(*(F.lit(v) for v in table[n])), F.col(n)) for n in names), F.lit(0.0))
    # measures overlap, so their sum is damped; the path's share takes the place of the global prior
    odds = F.round(told / math.sqrt(len(names)) * 1.5 + F.log(F.col("path_share") / (1 - F.col("path_share"))), 9)
    score = 1 / (1 + F.exp(-odds))
    return rows.join(
        shares, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
    ).select(
        "doc_id",
        "held_out",
        "host",
        "path",
        "host_share",
        "path_share",
        F.round(told, 9).alias("text_evidence"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )
