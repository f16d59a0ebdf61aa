"""Document quality by weak labels: heuristic labellers, their accuracies by EM, a hashed linear scorer."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stage

#: Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that it for with on as was be by this are from or an "
    "le la les de des et un une en que qui pour dans par sur est pas au plus du "
    "der die das und ist nicht ein eine zu mit von den im auf sich auch als "
    "el los las y del se con no por su para una al lo como es"
).split()
#: Documents that the linear scorer is fitted on, at most.
TRAIN_ROWS = 20_000
FEATURES = 4096
LOW, GOOD = 0, 1


def _share(part, whole):
    return part / F.greatest(whole, F.lit(1))


def _counts(text) -> dict:
    """What the labellers look at: plain columns, as a struct would be unfolded and counted at each use."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(x) > 20)
    function_word = r"(?<!\S)(?:" + "|".join(sorted(set(FUNCTION_WORDS))) + r")(?=[\s,.;])"
    count = {
        "words": r"\S+",
        "symbols": r"[#$%&*<>{}\\^~=_]{2,}",
        "shouts": "!!",
        "capitals": r"\p{Lu}",
        "bars": r" \| ",
        "function_words": function_word,
        "sentences": r"\p{L}[.?!](?:\s|$)",
    }
    sizes = {"chars": F.length(text), "lines": F.size(lines), "unlike": F.size(F.array_distinct(lines))}
    return sizes | {name: F.regexp_count(text, F.lit(p)) for name, p in count.items()}


def votes(c) -> dict:
    """Each labeller's vote by the counts of a text: 0 low, 1 good, null where it abstains."""
    enough = c["words"] >= 20

    def vote(low, good):
        return F.when(enough & low, LOW).when(enough & good, GOOD)

    def by(name, whole="words"):
        return _share(c[name], c[whole])

    same = F.lit(1.0) - _share(c["unlike"], c["lines"])
    long = c["lines"] >= 4
    return {
        "symbols": vote(by("symbols") > 0.1, by("symbols") < 0.02),
        "shouts": vote(by("shouts") > 0.1, by("shouts") < 0.02),
        "capitals": vote(by("capitals", "chars") > 0.3, by("capitals", "chars") < 0.12),
        "bars": vote(by("bars") > 0.1, by("bars") < 0.02),
        "function_words": vote(by("function_words") < 0.03, by("function_words") > 0.1),
        "sentences": vote((by("sentences") > 0.5) | (by("sentences") < 0.002), by("sentences") > 0.01),
        "repetition": F.when(long & (same > 0.5), LOW).when(long & (same < 0.2), GOOD),
    }


def fit_labellers(counts: list[tuple], n_labellers: int, rounds: int = 200) -> np.ndarray:
    """P(good) of each row of ``counts``, a tuple of votes and a count at the end.

    Expectation-maximisation of the two-class model in which labellers err independently of each other:
    a prior, and for each labeller and class the chances of low, good and abstaining. It starts from the
    majority of votes.
    """
    seen = np.array([[2 if v is None else v for v in row[:n_labellers]] for row in counts])
    weight = np.array([row[-1] for row in counts], float)
    good = ((seen == GOOD).sum(1) + 1.0) / ((seen != 2).sum(1) + 2.0)
    low_heavy = (seen == LOW).sum(1)
    good = np.where(low_heavy >= 2, np.minimum(good, 0.2), np.where(low_heavy == 1, np.minimum(good, 0.5), good))
    for _ in range(rounds):
        each = np.stack([1 - good, good]) * weight
        prior = (each.sum(1) + 1) / (weight.sum() + 2)
        logs = np.log(prior)[:, None] + np.zeros_like(each)
        for k in range(n_labellers):
            chance = np.stack([np.bincount(seen[:, k], c, 3) + [0.5, 0.5, 0.5] for c in each])
            chance /= chance.sum(1, keepdims=True)
            logs += np.log(chance)[:, seen[:, k]]
        before, good = good, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(before - good).max() < 1e-9:
            break
    none = (seen == 2).all(1)
    if none.any() and not none.all():  # silence is no evidence: the prior holds
        good[none] = (good[~none] * weight[~none]).sum() / weight[~none].sum()
    return good


def _with_votes(docs: DataFrame, text) -> DataFrame:
    """Adds ``__votes``, a struct of each labeller's vote."""
    counts = _counts(text)
    counted = docs.withColumns({f"__n_{k}": v for k, v in counts.items()})
    cast = votes({k: F.col(f"__n_{k}") for k in counts})
    voted = counted.withColumns({f"__v_{k}": v.cast("int") for k, v in cast.items()})
    both = voted.withColumn("__votes", F.struct(*[F.col(f"__v_{k}").alias(k) for k in cast]))
    return both.drop(*[f"__n_{k}" for k in counts], *[f"__v_{k}" for k in cast])


def shapes(text):
    """Words with runs of letters and digits folded: ``The***`` becomes ``Aa***``."""
    folded = F.regexp_replace(F.regexp_replace(text, r"\p{Lu}+", "A"), r"[\p{Ll}\p{Lo}\p{Mn}]+", "a")
    return F.filter(F.split(F.regexp_replace(folded, r"\p{N}+", "0"), r"\s+"), lambda x: x != "")


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """All columns of ``docs`` and n_low, n_good (votes), posterior, score and keep.

    The labellers vote on every document; the counts of all patterns of votes, of which there are at
    most 3 to the number of labellers, fit the label model. Its posteriors label up to ``train_rows``
    documents, those with the smallest hash of their text, and weight them by how sure they are; a
    logistic regression on hashed word shapes is fitted on these. ``score`` is its chance of good, and
    ``keep`` whether that reaches ``threshold``. Texts of under 20 words get hardly a vote and are judged
    by their shapes.

    Null texts, and texts without words, have a null score and are not kept. Columns of ``docs`` with
    these names are replaced. Repeated rows are judged alike; an empty table gives an empty result.
    """
    text = F.col(f"`{text_col}`")
    own = ["n_low", "n_good", "posterior", "score", "keep"]
    voted = _with_votes(docs.drop(*own), text)
    names = voted.schema["__votes"].dataType.names
    worded = text.isNotNull() & text.rlike(r"\S")
    patterns = voted.where(worded).groupBy("__votes").count()
    # At most 3 ** len(names) rows.
    counted = [(*r[0], r[1]) for r in patterns.collect()]
    spark = docs.sparkSession
    fitted = fit_labellers(counted, len(names)) if counted else []
    rows = [(*r[:-1], float(p)) for r, p in zip(counted, fitted, strict=True)]
    kinds = ", ".join(f"{n} int" for n in names)
    table = spark.createDataFrame(rows, f"{kinds}, posterior double")
    table = F.broadcast(table.select(F.struct(*names).alias("__votes"), "posterior"))

    def with_posterior(rows):
        return rows.join(table, rows["__votes"].eqNullSafe(table["__votes"]), "left").drop(table["__votes"])

    judged = with_posterior(voted)
    hashed = HashingTF(inputCol="__shapes", outputCol="__counts", numFeatures=FEATURES)
    scaled = Normalizer(inputCol="__counts", outputCol="__features", p=2.0)

    worded_texts = docs.where(worded).select(text.alias("__t"), F.xxhash64(text).alias("__h"))
    pick = stage(worded_texts.select("__h").distinct().orderBy("__h").limit(train_rows), "picked")
    chosen = stage(worded_texts.join(pick, "__h", "left_semi").dropDuplicates(["__h"]), "chosen")
    chosen = with_posterior(_with_votes(chosen, F.col("__t")))
    training = stage(
        chosen.select(
            shapes(F.col("__t")).alias("__shapes"), F.when(F.col("posterior") >= 0.5, 1.0).otherwise(0.0).alias("__label"),
            F.abs(2 * F.col("posterior") - 1).alias("__weight"),
        ),
        "training",
    )
    kinds_seen = {r[0] for r in training.select("__label").distinct().collect()}
    out = judged.withColumn("__ok", worded)
    if kinds_seen == {0.0, 1.0}:
        regression = LogisticRegression(
            featuresCol="__features", labelCol="__label", weightCol="__weight", maxIter=50, regParam=1e-3, tol=1e-6
        )
        model = Pipeline(stages=[hashed, scaled, regression.setProbabilityCol("__p").setRawPredictionCol("__raw").setPredictionCol("__y")]).fit(training)
        shaped = out.withColumn("__shapes", F.coalesce(F.when(F.col("__ok"), shapes(text)), F.array().cast("array<string>")))
        out = model.transform(shaped).withColumn("score", F.round(vector_to_array("__p")[1], 6))
    else:  # one class only: nothing to tell apart
        out = out.withColumn("score", F.lit(max(kinds_seen, default=1.0)))
    tally = [sum((F.when(F.col("__votes")[n] == k, 1).otherwise(0) for n in names), F.lit(0)) for k in (LOW, GOOD)]
    score = F.when(F.col("__ok"), F.col("score"))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in own],
        tally[0].alias("n_low"), tally[1].alias("n_good"), F.round("posterior", 6).alias("posterior"), score.alias("score"),
        F.coalesce(score >= threshold, F.lit(False)).alias("keep"),
    )
