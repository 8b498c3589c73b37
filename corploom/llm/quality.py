"""Quality by weak supervision: rules vote or abstain, their accuracies are
estimated without labels, and the posterior probability of good decides.

Each rule votes good (1), bad (-1) or abstains (0) on a document. What the estimate
needs of the corpus is how many documents have each pattern of votes, a table of
at most ``3 ** len(RULES)`` rows. Expectation-maximisation runs over that table: given
the accuracies, the posterior of each pattern; given the posteriors, the share of
good documents and how often each rule votes how on good ones and on those with each
defect. All of it is DataFrame expressions; a round returns one row of sums.

Null text has no words. Every document is judged by itself, so repeated rows get
equal results. Only the identifier and the text are read. An empty table gives an
empty result. The windows of three words are compared by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.frames import BLANKS, pick, text_of
from corploom.session import stage

ROUNDS = 12
RULES: dict[str, tuple[str, str]] = {
    # rule: (good if, bad if); it abstains otherwise
    "long_enough": ("n_words >= 100", "n_words < 5"),
    "word_length": (
        "word_chars between 3 * n_words and 7 * n_words",
        "word_chars < 2 * n_words or word_chars > 12 * n_words",
    ),
    "sentences": ("n_lines > 0 and 2 * n_ended_lines >= n_lines", "n_lines >= 3 and 10 * n_ended_lines < n_lines"),
    "symbols": ("false", "10 * n_symbols > n_words"),
    "same_lines": ("false", "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines"),
    "same_phrases": ("false", "10 * n_repeat_words > 3 * n_words"),
    "upper_case": ("false", "10 * n_upper > 3 * word_chars"),
    "digits": ("false", "10 * n_digits > 3 * word_chars"),
    "shouting": ("false", "2 * n_bangs > n_words"),
}
# A bad document mostly has one defect, so the model has a class of bad documents
# for each rule that finds one, beside the class of good ones. The start and the
# bounds say what a rule is taken to be: it condemns few good documents, and most
# documents of its own class.
DEFECTS = ("symbols", "same_lines", "same_phrases", "upper_case", "digits", "shouting")
CLASSES = ("good", *DEFECTS)
START = {"good share": 0.8, "bad of good": 0.005, "bad of own": 0.9, "bad of other": 0.1, "good": 0.6}
GOOD_CONDEMNED, OWN_CAUGHT = 0.005, 0.5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words in windows of three that occur twice or more, the first included."""

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return F.filter(s, lambda x, t: same(x, t + 1) | F.when(t > 0, same(x, t - 1)).otherwise(F.lit(False)))

        starts = F.sort_array(F.transform(_let(pairs, twice), lambda x: x["i"]))

        def width(p: Column) -> Column:
            # a window adds what the next one does not cover
            steps = F.transform(p, lambda x, t: F.least(F.coalesce(F.get(p, t + 1) - x, F.lit(3)), F.lit(3)))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
            _let(starts, width)
        )

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 3, F.lit(0).cast("bigint")).otherwise(_let(hashes, covered))

    return windows(words)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and what the rules look at."""
    text = text_of()
    spaced = F.translate(text, BLANKS[1:], " " * (len(BLANKS) - 1))

    def measures(w: Column) -> Column:
        chars = F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x))
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"), chars.alias("word_chars"), _repeated(w).alias("n_repeat_words")
        )

    def lines(k: Column) -> Column:
        return F.struct(
            F.size(k).cast("bigint").alias("n_lines"),
            (F.size(k) - F.size(F.array_distinct(k))).cast("bigint").alias("n_dup_lines"),
            F.size(F.filter(k, lambda x: F.substring(F.rtrim(x, F.lit(BLANKS)), -1, 1).isin(*'.!?"'))).cast("bigint").alias("n_ended_lines"),
        )

    words = _let(F.array_remove(F.split(spaced, " "), ""), measures)
    kept_lines = _let(F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != ""), lines)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("bigint")
    return pick(docs, id=id_col, text=text_col).select(
        "id",
        words.alias("w"),
        kept_lines.alias("k"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        count(r"[A-Z]").alias("n_upper"),
        count(r"[0-9]").alias("n_digits"),
        count(r"[!?]").alias("n_bangs"),
    ).select(F.col("id").alias(id_col), "w.*", "k.*", "n_symbols", "n_upper", "n_digits", "n_bangs")


def votes(measured: DataFrame) -> DataFrame:
    """Adds one column of -1, 0 or 1 per rule."""
    vote = lambda good, bad: F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)
    return measured.withColumns({rule: vote(good, bad) for rule, (good, bad) in RULES.items()})


def start() -> dict[str, float]:
    """Before any data: ``share/class`` and ``class/rule/vote``."""
    rest = (1 - START["good share"]) / len(DEFECTS)
    model = {f"share/{c}": START["good share"] if c == "good" else rest for c in CLASSES}
    for c in CLASSES:
        for rule, (good, _) in RULES.items():
            bad = START["bad of good"] if c == "good" else START["bad of own" if c == rule else "bad of other"]
            model[f"{c}/{rule}/bad"] = bad
            model[f"{c}/{rule}/good"] = 0.0 if good == "false" else START["good"] * (1 - bad)
    return model


def _weight(model: dict[str, float], c: str) -> str:
    """Share of the class times the probability of the votes in it, as SQL."""
    factors = [repr(model[f"share/{c}"]) + "D"]
    for rule in RULES:
        bad, good = model[f"{c}/{rule}/bad"], model[f"{c}/{rule}/good"]
        factors.append(f"CASE {rule} WHEN -1 THEN {bad!r}D WHEN 1 THEN {good!r}D ELSE {1 - bad - good!r}D END")
    return " * ".join(factors)


def posterior(voted: DataFrame, model: dict[str, float]) -> DataFrame:
    """Adds the probability of each class as ``p_class``."""
    total = " + ".join(f"w_{c}" for c in CLASSES)
    weighed = voted.selectExpr("*", *[f"{_weight(model, c)} AS w_{c}" for c in CLASSES])
    return weighed.selectExpr(*voted.columns, *[f"w_{c} / ({total}) AS p_{c}" for c in CLASSES])


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """The model from ``n`` documents of each pattern of votes."""
    model = start()
    sums = ["sum(n) AS n", *[f"sum(n * p_{c}) AS n_{c}" for c in CLASSES]]
    for c in CLASSES:
        for rule, (good, _) in RULES.items():
            for vote, name in ((-1, "bad"), (1, "good")):
                if vote == -1 or good != "false":
                    sums.append(f"sum(if({rule} = {vote}, n * p_{c}, 0D)) AS `{c}/{rule}/{name}`")
    totals = [F.expr(e) for e in sums]
    for _ in range(rounds):
        row = posterior(patterns, model).agg(*totals).first()
        if not row["n"]:  # no documents
            return model
        model = _updated(row.asDict())
    return model


def _updated(sums: dict[str, float]) -> dict[str, float]:
    """Rates of the sums, one document of each vote added, inside the bounds."""
    model = {}
    for c in CLASSES:
        n = sums[f"n_{c}"]
        model[f"share/{c}"] = (n + 1) / (sums["n"] + len(CLASSES))
        for rule in RULES:
            bad = (sums[f"{c}/{rule}/bad"] + 1) / (n + 3)
            if c == "good":
                bad = min(bad, GOOD_CONDEMNED)
            elif c == rule:
                bad = max(bad, OWN_CAUGHT)
            good = sums.get(f"{c}/{rule}/good")
            model[f"{c}/{rule}/bad"] = bad
            model[f"{c}/{rule}/good"] = 0.0 if good is None else min((good + 1) / (n + 3), 0.999 - bad)
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: the statistics, each rule's vote, ``quality`` (posterior of
    good), ``base_failed`` and ``kept``. Statistics and votes are staged; the caller's
    job deletes them."""
    voted = stage(votes(statistics(docs, id_col, text_col)), "quality-votes")
    # at most 3 ** rules rows; in one order and one task, so that sums repeat
    patterns = voted.groupBy(*RULES).agg(F.count("*").alias("n")).coalesce(1).sortWithinPartitions(*RULES)
    model = fit(stage(patterns, "quality-patterns"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = posterior(voted, model).withColumn("quality", F.col("p_good")).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
