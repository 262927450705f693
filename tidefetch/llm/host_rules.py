"""Quality rules judged by host: rule failures by domain, shrunk by an empirical beta prior.

Every document is measured and held against ``RULES``. Each host's share of failing documents
is shrunk towards all hosts' by a beta prior fitted to their shares, so a host of few documents
is not judged by them alone. Its posterior is a beta distribution; a verdict needs its bound, not
only its mean, to be far from the share of all documents. It goes back to the host's documents:

- ``trusted`` (the odds of failing at the upper bound are under ``TRUSTED`` of all documents'): kept.
- ``watched``: its documents are kept, but for those that fail a rule.
- ``rejected`` (the odds at the lower bound are over ``REJECTED`` times all documents'): none is kept.

Documents that fail a base rule are never kept. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefetch.llm.common import evaluate_once, settle

TRUSTED = 0.1
REJECTED = 4.0
#: Standard deviations of the posterior from its mean to its bounds.
DEVIATIONS = 1.645
#: Documents that the prior stands for, at least, and where hosts agree.
PRIOR_WEIGHT = (2.0, 1e9)
SALTS = 16

#: Rule failures beyond the base, over the measures.
RULES = {
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
}
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def _split(text: Column) -> dict[str, Column]:
    return {
        "words": F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""),
        "lines": F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
    }


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` without text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    Repeated three-word windows are found by 64-bit hashes, of which a text of n windows gives up
    log2(n) bits: the odds of one wrong pair in a text of 20,000 words are below one in a million.
    Everything happens inside a row, so texts are never shuffled. A null text counts as empty:
    all measures are 0. These columns replace columns of their names.
    """
    kept = [c for c in docs.columns if c not in {*MEASURES, "text"}]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = evaluate_once(docs.select(*kept, text.alias("__text")), "__a", **_split(F.col("__text")))
    words, size = F.col("__a.words"), F.size("__a.words")
    heads = F.when(size >= 3, F.slice(words, 1, F.greatest(size - 2, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    rows = evaluate_once(
        rows,
        "__b",
        windows=F.transform(heads, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
    )
    # Equal hashes meet when sorted. A key is the hash, without as many high bits as the window's
    # number needs, and that number.
    bits = F.coalesce(F.ceil(F.log2(F.size("__b.windows") + 1)).cast("int"), F.lit(1))
    repeats = F.size(F.array_distinct("__b.windows")) < F.size("__b.windows")
    keys = F.transform("__b.windows", lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("long")))
    rows = evaluate_once(rows, "__c", bits=bits, sorted=F.when(repeats, F.sort_array(keys)))
    order, bits = F.col("__c.sorted"), F.col("__c.bits")

    def hash_of(key: Column) -> Column:
        return F.call_function("shiftrightunsigned", key, bits)

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    twice = F.transform(
        order,
        lambda key, i: F.when(
            (hash_of(key) == hash_of(F.get(order, i - 1))) | (hash_of(key) == hash_of(F.get(order, i + 1))),
            key.bitwiseAND(mask),
        ),
    )
    starts = F.filter(twice, lambda i: i.isNotNull())
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
    measures = {
        "n_words": size,
        "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": F.col("__a.n_symbols"),
        "n_lines": F.size("__a.lines"),
        "n_dup_lines": F.size("__a.lines") - F.size(F.array_distinct("__a.lines")),
        "n_repeat_words": F.when(order.isNull(), F.lit(0)).otherwise(F.size(covered)),
    }
    return rows.select(*kept, *[m.cast("long").alias(n) for n, m in measures.items()])


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def host_verdicts(judged: DataFrame) -> DataFrame:
    """host, n_docs, n_failed, failed_share (shrunk), its bounds share_low and share_high, and verdict,
    from rows of host and failed.

    The beta prior is fitted by moments: its mean is the share of all documents, its weight
    follows from how much more the hosts' shares spread than chance would make them. A single
    host, or hosts that agree, get the largest weight, and so no verdict but ``watched``.
    """
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    share = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.count("*").alias("k"),
        F.sum(F.col("n_docs") * share * share).alias("squares"),
    )
    mean, n, k = F.col("f") / F.col("n"), F.col("n"), F.col("k")
    spread = F.col("squares") / n - mean * mean
    chance = mean * (1 - mean)
    # The weighted variance of shares is chance * (1 + (m - 1) / (weight + 1)) / m for hosts of m documents.
    m = n / k
    extra = m * spread / chance - 1
    weight = F.when((chance > 0) & (extra > 0) & (k > 1), (m - 1) / extra - 1).otherwise(F.lit(PRIOR_WEIGHT[1]))
    prior = moments.select(
        mean.alias("mean"),
        F.least(F.greatest(weight, F.lit(PRIOR_WEIGHT[0])), F.lit(PRIOR_WEIGHT[1])).alias("weight"),
    ).first()
    if prior is None or prior["mean"] is None:
        centre, heavy = 0.0, PRIOR_WEIGHT[1]
    else:
        centre, heavy = float(prior["mean"]), float(prior["weight"])
    size = F.col("n_docs") + heavy
    shrunk = (F.col("n_failed") + centre * heavy) / size
    reach = DEVIATIONS * F.sqrt(shrunk * (1 - shrunk) / (size + 1))
    hosts = hosts.select(
        "*",
        shrunk.alias("failed_share"),
        F.greatest(shrunk - reach, F.lit(0.0)).alias("share_low"),
        F.least(shrunk + reach, F.lit(1.0)).alias("share_high"),
    )
    low, high = F.col("share_low"), F.col("share_high")
    # Odds are compared without dividing, as a share may be 0 or 1.
    verdict = (
        F.when(low * (1 - centre) > REJECTED * centre * (1 - low), "rejected")
        .when(high * (1 - centre) < TRUSTED * centre * (1 - high), "trusted")
        .otherwise("watched")
    )
    return hosts.withColumn("verdict", verdict)


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the measures, base_failed, rules_failed, host_failed_share, host_verdict and kept.

    One row for each row of ``docs``; repeated rows are judged alike. A null host is a host of its
    own. Documents are dealt over ``SALTS`` parts of their host for the join, so one host with a
    third of all rows is no hot spot; the host's counts are summed before any shuffle.
    """
    rows = docs.select("doc_id", F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    measured = measure(rows)
    failed = [F.when(F.expr(rule), F.lit(name)) for name, rule in RULES.items()]
    measured = measured.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn(
        "rules_failed", F.array_compact(F.array(*failed))
    )
    # Written once: the texts are measured once for the hosts and for the documents.
    measured = settle(measured, "measures")
    bad = F.col("base_failed") | (F.size("rules_failed") > 0)
    hosts = host_verdicts(measured.select("host", bad.alias("failed")))
    salted = hosts.select(
        F.coalesce(F.concat(F.lit("="), "host"), F.lit("")).alias("__key"),
        F.col("failed_share").alias("host_failed_share"),
        F.col("verdict").alias("host_verdict"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"),
    )
    keyed = measured.withColumn("__key", F.coalesce(F.concat(F.lit("="), "host"), F.lit(""))).withColumn(
        "__salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
    )
    kept = ~F.col("base_failed") & F.when(F.col("host_verdict") == "rejected", False).when(
        F.col("host_verdict") == "trusted", True
    ).otherwise(F.size("rules_failed") == 0)
    return keyed.join(salted, ["__key", "__salt"]).withColumn("kept", kept).drop("__key", "__salt")


def digest(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
