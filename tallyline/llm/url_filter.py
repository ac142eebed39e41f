"""URL verdicts: suffix rules first, gradient-boosted trees for the rest.

Rules name a host and a path prefix; a rule fits its host and all subdomains,
and the longest rule that fits decides.  Urls that no rule fits are judged by
boosted trees on lexical features: lengths, depth, digit ratio, character
entropy, parameter counts and how often the host's suffix and the first path
segment are blocked among labelled urls.

Labelled urls are those that a rule decides.  The trees are fitted on at most
``TRAIN_ROWS`` distinct labelled urls per verdict, chosen by the smallest
digests of the urls, so a rerun fits the same trees; a sampled url weighs as
much as those of its verdict that it stands for.  The suffix statistics are
counted over all labelled urls; a training row's leave out its host's fold.
Without labelled urls of both verdicts the
model gives the only verdict there is, or ``allow``.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is judged by its features; repeated rows are judged
alike; a null page_id is kept; an empty table gives no rows; other columns are
carried unchanged by ``judged``, whose own columns are in one struct (a column
``judged`` of the input is replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import BROADCAST_IDS, fresh
from tallyline.sources.stage import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRAIN_ROWS = 10_000
TREES, DEPTH, SEED = 20, 4, 7
SUBSET = "onethird"  # of the features, tried at each split: the rates alone would decide all
FOLDS = 5
PRIOR = 20.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
FEATURES = (
    "url_length", "host_length", "path_length", "host_labels", "depth", "digit_ratio",
    "entropy", "parameters", "query_length", "hyphens", "suffix_rate", "suffix_seen", "segment_rate",
)


def host_of(url: str) -> Column:
    after = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END")
    host = F.regexp_extract(F.coalesce(after, F.lit("")), r"(?s)\A[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: str) -> Column:
    after = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END")
    return F.regexp_extract(F.coalesce(after, F.lit("")), r"(?s)\A[^/?#]*([^?#]*)", 1)


def rule_of(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits ``host`` and ``path``; else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = (
            (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        ) & F.col("path").startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def entropy(text: str) -> Column:
    """Shannon entropy of a text's characters in bits."""
    return F.expr(
        f"aggregate(array_distinct(split({text}, '')), 0D, (sum, c) -> sum - "
        f"(length({text}) - length(replace({text}, c, ''))) / length({text}) * "
        f"log2((length({text}) - length(replace({text}, c, ''))) / length({text})))"
    )


def features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the features that need no statistics."""
    url = F.coalesce("url", F.lit(""))
    made = urls.withColumn("u", url).withColumn("query", F.regexp_extract("u", r"(?s)\?([^#]*)", 1))
    size = F.greatest(F.length("u"), F.lit(1))
    plain = {
        "url_length": F.length("u"),
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "host_labels": F.size(F.split("host", r"\.")),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")),
        "digit_ratio": F.length(F.regexp_replace("u", "[^0-9]", "")) / size,
        "entropy": F.when(F.length("u") > 0, entropy("u")).otherwise(0.0),
        "parameters": F.size(F.filter(F.split("query", "&"), lambda x: x != "")),
        "query_length": F.length("query"),
        "hyphens": F.length(F.regexp_replace("u", "[^-]", "")),
        "suffix": F.substring_index("host", ".", -1),
        "segment": F.regexp_extract("path", r"(?s)\A/([^/]*)", 1),
    }
    return made.select(*(c for c in made.columns if c not in ("u", "query")), *(v.alias(k) for k, v in plain.items()))


def sums(labelled: DataFrame, by: str) -> DataFrame:
    """Labelled and blocked urls per value, in all and per fold of the host."""
    folds = [F.count_if(F.col("fold") == f) for f in range(FOLDS)]
    blocked = [F.sum(F.when(F.col("fold") == f, F.col("label")).otherwise(0.0)) for f in range(FOLDS)]
    return labelled.groupBy(by).agg(
        F.array(F.count(F.lit(1)), *folds).alias(f"{by}_n"), F.array(F.sum("label"), *blocked).alias(f"{by}_blocked")
    )


def with_rates(made: DataFrame, tables: dict[str, DataFrame], apart: bool) -> DataFrame:
    """Share of blocked urls per value, pulled towards one half where few were seen.

    ``apart`` leaves out the urls of the row's own fold, so that no host's labels
    tell of themselves.
    """
    own = F.col("fold") + 1 if apart else None
    for by, table in tables.items():
        small = table.count() <= BROADCAST_IDS
        made = made.join(F.broadcast(table) if small else table, by, "left")
        of = lambda c: F.coalesce(F.col(c)[0] - (F.get(c, own) if apart else 0), F.lit(0)).cast("double")
        made = made.withColumns(
            {
                f"{by}_rate": (of(f"{by}_blocked") + PRIOR / 2) / (of(f"{by}_n") + PRIOR),
                f"{by}_seen": F.log1p(of(f"{by}_n")),
            }
        ).drop(f"{by}_n", f"{by}_blocked")
    return made


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """``pages`` with a struct ``judged``: host, path, rule, verdict, score (chance of block).

    Urls are judged once per distinct url.
    """
    text, verdict = rule_of(rules)
    key = fresh(pages, "_url")
    distinct = (
        pages.select(F.col(url).alias("url"))
        .distinct()
        .select("url", host_of("url").alias("host"), path_of("url").alias("path"))
        .select("*", text.alias("rule"), verdict.alias("by_rule"))
    )
    urls = stage(features(distinct), "url-features")
    labelled = urls.where("by_rule IS NOT NULL").withColumn(
        "label", F.when(F.col("by_rule") == "block", 1.0).otherwise(0.0)
    ).withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int"))
    counts = {r["by_rule"]: r["n"] for r in labelled.groupBy("by_rule").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) == 2:
        tables = {by: stage(sums(labelled, by), f"url-{by}") for by in ("suffix", "segment")}
        known = with_rates(urls, tables, apart=False)
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        # A bounded sample per verdict: the urls with the smallest digests.
        digest = F.xxhash64("url")
        sample = [
            labelled.where(F.col("by_rule") == v).orderBy(digest, "url").limit(TRAIN_ROWS)
            .withColumn("weight", F.lit(max(n / TRAIN_ROWS, 1.0)))
            for v, n in counts.items()
        ]
        drawn = with_rates(sample[0].unionByName(sample[1]), tables, apart=True)
        train = stage(drawn.select("label", "weight", *FEATURES), "url-train")
        model = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", weightCol="weight",
            subsamplingRate=1.0, featureSubsetStrategy=SUBSET,
        ).fit(vectors.transform(train))
        scored = model.transform(vectors.transform(known)).withColumn(
            "score", vector_to_array("probability")[1]
        )
    else:
        only = 1.0 if set(counts) == {"block"} else 0.0
        scored = urls.withColumn("score", F.lit(only))
    result = stage(
        scored.select(
            F.col("url").alias(key),
            F.struct(
                "host",
                "path",
                "rule",
                F.coalesce("by_rule", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"),
                "score",
            ).alias("judged"),
        ),
        "url-judged",
    )
    return pages.drop("judged").join(result, F.col(url).eqNullSafe(F.col(key))).drop(key)
