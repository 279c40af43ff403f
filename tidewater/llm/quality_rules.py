"""Quality rules whose cutoffs come with a bound on the good documents they reject.

Every rule compares a figure of a document, in thousandths, with a cutoff. In each stratum the labelled good
documents are the holdout: the cutoffs are a fixed list, chosen without them. A cutoff is certified when the exact
binomial test says that it rejects a share of at most ``alpha / rules`` of good documents. Cutoffs of a rule are
tested from the loosest on and testing stops at the first failure, so they need no correction among each other;
over rules and strata the level ``delta`` is divided (Bonferroni). With probability ``1 - delta`` no stratum loses
more than ``alpha`` of its good documents. Of the certified cutoffs a rule takes the one with the best balance of
rejected bad and rejected good documents, or none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import SPACES, saved, small_side, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULES = ("symbols", "repeats", "dup_lines", "capitals", "exclaims")
CUTOFFS = (900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 150, 125, 100, 75, 50, 40, 30, 20, 10)
#: A rejected good document counts as so many rejected bad ones, both as shares, when a certified cutoff is chosen.
COST = 20


def _removed(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _thousandths(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(F.lit(0)).cast("long")


def with_figures(docs: DataFrame, text: str = "text", name: str = "figures") -> DataFrame:
    """``docs`` with a struct of counts and of the rules' figures. A null text has no words and no lines.

    ``n_repeat_words`` counts the words in 3-word windows that the text has twice or more: the windows' hashes are
    sorted with their places, neighbours with equal hashes mark their places, and the marked places are merged.
    """
    body, w, grams, marked, places = (f"{name}__{x}" for x in ("text", "words", "grams", "marked", "places"))
    out = docs.withColumn(body, F.coalesce(F.col(text), F.lit(""))).withColumn(w, words(F.col(body)))
    out = out.withColumn(grams, F.sort_array(F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(F.col(w)[i], F.col(w)[i + 1], F.col(w)[i + 2]).alias("h"), i.alias("p"))))))

    def same(i: Column, j: Column) -> Column:
        return F.get(F.col(grams), i)["h"] == F.get(F.col(grams), j)["h"]

    out = out.withColumn(marked, F.transform(grams, lambda x, i: F.when(
        F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)), x["p"])))
    out = out.withColumn(places, F.sort_array(F.array_compact(marked)))
    repeat = F.aggregate(
        F.transform(places, lambda p, i: F.coalesce(F.least(F.lit(3), F.get(F.col(places), i + 1) - p), F.lit(3))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    lines = F.filter(F.split(F.col(body), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn(name, F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.translate(F.col(body), SPACES, "")).cast("long").alias("word_chars"),
        _removed(F.col(body), SYMBOLS).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.coalesce(repeat, F.lit(0)).cast("long").alias("n_repeat_words"),
        _removed(F.col(body), CAPITALS).cast("long").alias("n_capitals"),
        _removed(F.col(body), "!").cast("long").alias("n_exclaims"))).drop(body, w, grams, marked, places)
    f = F.col(name)
    out = out.withColumn(name, f.withField("n_lines", F.size(f["lines"]).cast("long"))
                         .withField("n_dup_lines", (F.size(f["lines"]) - F.size(F.array_distinct(f["lines"])))
                                    .cast("long")).dropFields("lines"))
    return out.withColumn(name, F.struct(
        f["n_words"], f["word_chars"], f["n_symbols"], f["n_dup_lines"], f["n_repeat_words"],
        ((f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])).alias("base_failed"),
        _thousandths(f["n_symbols"], f["word_chars"]).alias("symbols"),
        _thousandths(f["n_repeat_words"], f["n_words"]).alias("repeats"),
        _thousandths(f["n_dup_lines"], f["n_lines"]).alias("dup_lines"),
        _thousandths(f["n_capitals"], f["word_chars"]).alias("capitals"),
        _thousandths(f["n_exclaims"], f["word_chars"]).alias("exclaims")))


def log_binomial_cdf(k: Column, n: Column, share: float) -> Column:
    """Logarithm of P(Bin(n, share) <= k), summed term by term in logarithms, so it never underflows."""
    odds = math.log(share / (1 - share))
    first = n * F.lit(math.log(1 - share))
    start = F.struct(first.cast("double").alias("term"), first.cast("double").alias("total"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    return F.when(k < 1, first).otherwise(
        F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), start, step, lambda a: a["total"]))


def certified_cutoffs(
    figures: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05,
) -> DataFrame:
    """``(stratum, rule, cutoff)`` of the rules that are in force.

    ``figures`` has ``doc_id``, ``stratum`` and ``figures``; ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad;
    others count as none; of several labels of a document the best counts). Documents that fail the base are left out:
    the rules don't decide on them.
    """
    share = alpha / len(RULES)
    marks = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
        (F.max("quality") == 1).alias("good"))
    held = figures.where(~F.col("figures.base_failed")).join(marks, "doc_id").select(
        "stratum", "good", F.explode(F.array(*[
            F.struct(F.lit(r).alias("rule"), F.col(f"figures.{r}").alias("figure")) for r in RULES])).alias("r"))
    counts = held.groupBy("stratum", F.col("r.rule").alias("rule")).agg(
        F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"),
        F.array(*[F.struct(
            F.lit(i).alias("step"), F.lit(c).cast("long").alias("cutoff"),
            F.count_if(F.col("good") & (F.col("r.figure") >= c)).alias("lost"),
            F.count_if(~F.col("good") & (F.col("r.figure") >= c)).alias("caught"))
            for i, c in enumerate(CUTOFFS)]).alias("tests"))
    counts = saved(counts)
    n_strata = counts.select(F.struct("stratum")).distinct().count()
    tests = counts.select("stratum", "rule", "n_good", "n_bad", F.inline("tests"))
    passed = (F.col("lost") <= share * F.col("n_good")) & (
        log_binomial_cdf(F.when(F.col("lost") <= share * F.col("n_good"), F.col("lost")).otherwise(F.lit(0)),
                         F.col("n_good"), share)
        <= math.log(delta / (max(1, n_strata) * len(RULES))))
    own = Window.partitionBy("stratum", "rule")
    score = F.col("caught") / F.col("n_bad") - COST * F.col("lost") / F.col("n_good")
    valid = tests.withColumn("failed", F.sum(F.when(passed, 0).otherwise(1)).over(
        own.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))).where(
        "failed = 0 AND caught > 0").withColumn("score", score)
    best = valid.groupBy("stratum", "rule").agg(
        F.max_by(F.struct("score", "cutoff"), F.struct("score", "cutoff")).alias("best"))
    return best.where("best.score > 0").select("stratum", "rule", "best.cutoff")


def _decided(
    docs: DataFrame, labels: DataFrame, stratum: str, alpha: float, delta: float, columns: list[str],
) -> DataFrame:
    """``columns`` of ``docs`` with ``figures`` and ``kept`` under names of their own."""
    figures = saved(with_figures(docs, name="quality__figures").select(
        *columns, "quality__figures", F.col(stratum).alias("quality__stratum")))
    limits = certified_cutoffs(figures.select(
        "doc_id", F.col("quality__stratum").alias("stratum"), F.col("quality__figures").alias("figures")),
        labels, alpha, delta)
    wide = limits.groupBy(F.col("stratum").alias("quality__key")).agg(
        *[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"quality__{r}") for r in RULES])
    joined = figures.join(small_side(saved(wide)), F.col("quality__stratum").eqNullSafe(F.col("quality__key")), "left")
    hits = [F.coalesce(F.col(f"quality__figures.{r}") >= F.col(f"quality__{r}"), F.lit(False)) for r in RULES]
    rejected = F.col("quality__figures.base_failed")
    for hit in hits:
        rejected = rejected | hit
    return joined.withColumn("quality__kept", ~rejected)


def quality_rules(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts, ``base_failed``, the rules' figures and ``kept``.

    Nulls: a null text counts as empty and fails the base; a null stratum is a stratum of its own; a null ``doc_id``
    has no label but is judged. Repeated rows give repeated results. Without documents or labels nothing is certified
    and only the base rejects. Other columns of ``docs`` are left out, whatever their names.
    """
    out = _decided(docs.select("doc_id", "text", F.col(stratum).alias("stratum")), labels, "stratum", alpha, delta, ["doc_id"])
    return out.select("doc_id", "quality__figures.*", F.col("quality__kept").alias("kept"))


def kept_documents(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return _decided(docs, labels, stratum, alpha, delta, docs.columns).where("quality__kept").select(*docs.columns)
