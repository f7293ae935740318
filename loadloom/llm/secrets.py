"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a value behind a hint word and a colon or an equals sign, of at least ``MIN_HINTED`` characters of any kind (with
blanks, if quoted); a value of at least ``MIN_ASSIGNED`` behind any equals sign, or behind a colon if it is quoted or has a
digit, unless it holds an assignment itself; a run of at least ``MIN_LENGTH`` letters, digits and ``_+/-`` with a digit in it, or
behind an equals sign; or of an issued format. Unquoted values end at a blank, a quote, an angle bracket or the next
assignment, without closing punctuation. The forest sees its length and
make-up, how often it changes between kinds of characters, how much of it dictionary words cover, whether it is part of a
path, and the words beside it. It learns from labelled findings; ``weak_labels`` makes some from formats that leave no doubt.
Only DataFrame functions and Spark's own forest run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadloom.llm.graphs import unused, written

MIN_LENGTH, MIN_ASSIGNED, MIN_HINTED = 12, 6, 4
_CHARS = r"A-Za-z0-9_+/\-"
#: Words that stand beside secrets, and beside what only looks like one.
HINTS = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key|bearer"
OTHERS = "commit|sha1|sha256|md5|checksum|digest|hash|uuid|guid|isbn|version|build|invoice|order|phone|card|account"


def _quoted(least: int, most: str, outside: str) -> str:
    return "|".join(rf"(?<={q})(?:\\[^\r\n]|[^{q}\\{outside}]){{{least},{most}}}+(?={q})" for q in "\"'`")


def _bare(least: int) -> str:
    """Closing punctuation counts if more of the value follows. Possessive, so that long values need no stack."""
    stop, core = r",;&.:)\]}", r"[^\s\"'`<>,;&.:)\]}]"
    more = rf"(?=[{stop}]{{1,20}}+{core})"
    return rf"(?<![\"'`])(?:{core}|{more}(?:[.:)\]}}]|[,;&](?![\"']?\w{{1,50}}[\"']?\s?[=:]))){{{least},}}+"


#: Whether the place is behind an assignment, and whether that assigns to a name with a hint word.
_BEHIND = r"(?<=[=:]\s{0,2}[\"'`]?)(?![=:>\s])"
_HINTED = rf"(?<=(?i:{HINTS})\w{{0,12}}[\"'\])]{{0,2}}\s{{0,2}}[=:]{{1,2}}\s{{0,2}}[\"'`]?)"
#: A value that is a URL or holds assignments is no value as a whole; its parts are.
_WHOLE = r"(?!//|[^\s\"'`]{0,200}\w[=:][^\s=\"'`])"
_SHAPE = r"(?:(?<=[\"'`])|(?<==\s{0,2})|(?=[^\s\"'`<>0-9]{0,200}+[0-9]))"
BLANK, LINE = r"\s", r"\r\n"
CANDIDATE = (
    rf"{_BEHIND}(?:{_HINTED}(?:{_quoted(MIN_HINTED, '', BLANK)}|{_quoted(MIN_HINTED, '', LINE)}|{_bare(MIN_HINTED)})"
    rf"|{_WHOLE}{_SHAPE}(?:{_quoted(MIN_ASSIGNED, '', BLANK)}|{_bare(MIN_ASSIGNED)}))"
    rf"|(?<![{_CHARS}])(?:(?:(?=[A-Za-z_+/\-]*+[0-9])|(?<==\s?[\"']?))[{_CHARS}]{{{MIN_LENGTH},}}+"
    rf"|(?:AKIA|ASIA)[A-Z0-9]{{16}}(?![{_CHARS}]))"
)
#: Context kept on either side, in characters.
CONTEXT = 48
#: Labelled findings that training takes at most, those with the smallest hash.
MAX_LABELLED = 20_000
REPLACEMENT = "[SECRET]"

#: Words that readable identifiers are made of.
DICTIONARY = (
    "account|address|admin|and|array|base|block|build|cache|class|client|code|config|content|count|data|date|default|demo|"
    "detail|document|dummy|email|error|example|false|field|file|filter|first|format|group|header|home|host|image|index|info|"
    "input|item|label|last|level|license|link|list|local|login|main|master|message|method|model|module|name|node|null|number|"
    "object|option|order|output|page|param|path|placeholder|point|product|project|public|query|release|report|request|response|"
    "result|sample|search|section|server|service|session|setting|size|source|start|state|status|string|style|system|table|"
    "target|template|test|text|the|time|title|true|type|update|upload|user|value|version|view|web|widget|window|with|your"
)
#: Formats fixed by those who issue them, whole or within a longer value.
ISSUED = (
    r"(?<![A-Za-z0-9_])((AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[baprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})"
    r"(?![A-Za-z0-9_-])"
)

FEATURES = ["n_chars", "digits", "uppers", "hex", "changes", "alternations", "distinct", "covered", "path", "hinted", "assigned", "quoted", "other", "issued"]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, ordinal, start, found, before, after) of every candidate in ``docs`` (doc_id, text).

    ``start`` counts code points from 0. Rows that agree in id and text give one set of candidates; null and empty texts give
    none; a null doc_id stays null. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"))
    rows = rows.where(F.size("found") > 0).withColumn("parts", F.split("text", CANDIDATE, -1))
    sides = F.transform(
        "found",
        lambda x, i: F.struct(
            i.alias("ordinal"),
            x.alias("found"),
            F.length(F.get("parts", i)).alias("gap"),
            F.right(F.get("parts", i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get("parts", i + 1), F.lit(CONTEXT)).alias("after"),
        ),
    )
    rows = rows.select("doc_id", "text_key", F.explode(sides).alias("c")).select("doc_id", "text_key", "c.*")
    rows = rows.distinct()
    before = Window.partitionBy("doc_id", "text_key").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.length("found")).over(before) - F.length("found")
    return rows.select("doc_id", "text_key", "ordinal", start.cast("bigint").alias("start"), "found", "before", "after")


def _share(x: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(x, pattern, "")) / F.length(x)


def with_features(found: DataFrame) -> DataFrame:
    x, before, after = F.col("found"), F.lower(F.col("before")), F.col("after")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "[0-9]", "\u0001"), "[a-z]", "a"), "[A-Z]", "A"), "[_+/-]", "-")
    runs = F.regexp_replace(kinds, r"(.)\1+", "$1")
    flag = lambda c: c.cast("double")
    return found.withColumns(
        {
            "n_chars": F.length(x).cast("double"),
            "digits": _share(x, "[^0-9]"),
            "uppers": _share(x, "[^A-Z]"),
            "hex": _share(x, "[^0-9a-fA-F]"),
            "changes": (F.length(runs) - 1) / F.length(x),
            "alternations": (F.length(runs) - F.length(F.regexp_replace(runs, "\u0001(?=[aA])|[aA](?=\u0001)", ""))) / F.length(x),
            "distinct": F.size(F.array_distinct(F.split(x, ""))) / F.length(x),
            "covered": 1 - _share(F.lower(x), DICTIONARY),
            "path": flag(x.contains("/") | before.rlike(r"[/\\.]$") | after.rlike(r"^[/\\]|^\.[A-Za-z]")),
            "hinted": flag(before.rlike(rf"({HINTS})\W{{0,6}}(\w+\W{{1,4}})?$")),
            "assigned": flag(before.rlike(r"[=:]\s*[\"']?$")),
            "quoted": flag(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")),
            "other": flag(before.rlike(rf"\b({OTHERS})\W{{0,6}}(\w+\W{{1,4}})?$")),
            "issued": flag(x.rlike(ISSUED)),
        }
    )


def weak_labels(rows: DataFrame) -> DataFrame:
    """Rows of ``with_features`` whose label is beyond doubt: issued formats and assigned, hinted values with a digit or of
    ``MIN_LENGTH`` characters, without blanks, are secrets (1); plain numbers, covered words and named digests are not (0)."""
    plain = (F.col("digits") == 1) | (F.col("covered") > 0.5) | ((F.col("other") == 1) & (F.col("hinted") == 0))
    mixed = F.col("found").rlike("[0-9]") | (F.col("n_chars") >= MIN_LENGTH)
    secret = (F.col("issued") == 1) | (mixed & ~F.col("found").rlike(r"\s") & (F.col("hinted") == 1) & (F.col("assigned") == 1) & (F.col("digits") < 1) & (F.col("covered") < 0.3))
    return rows.withColumn("label", F.when(plain, 0.0).when(secret, 1.0)).where("label is not null")


def _bounded(rows: DataFrame, n: int, most: int, order: Column) -> DataFrame:
    """The ``most`` rows of ``n`` with the smallest hash. Those far above it go before anything is sorted, in every task alone."""
    if n <= most:
        return rows
    # Ten deviations above ``most``: that fewer are left is out of the question.
    share = (most + 10 * most**0.5 + 100) / n
    if share < 1:
        rows = rows.where(order < F.lit(int(-(2**63) + share * 2**64)))
    return rows.orderBy(order, "found", "before", "after").limit(most)


def fit_forest(labelled: DataFrame, max_rows: int = MAX_LABELLED, trees: int = 20, depth: int = 6, seed: int = 5) -> PipelineModel | float:
    """A forest from labelled findings (the columns of ``with_features`` and ``label``), at most ``max_rows`` of each label.

    Rows with a null label are passed over. If all have one label, that label is the model; without any, 1.0 is, so that
    nothing is taken for a false positive unlearned.
    """
    order = F.xxhash64("found", "before", F.lit(seed))
    rows = written(labelled.where("label is not null").select("label", "found", "before", "after", *FEATURES).distinct(), "labelled")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return 1.0
    rows = written(reduce(DataFrame.unionByName, [_bounded(rows.where(F.col("label") == x), n, max_rows, order) for x, n in sorted(counts.items())]), "bounded")
    labels = [r["label"] for r in rows.select("label").distinct().limit(3).collect()]
    if len(labels) < 2:
        return labels[0] if labels else 1.0
    inputs = VectorAssembler(inputCols=FEATURES, outputCol="inputs")
    forest = RandomForestClassifier(featuresCol="inputs", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8)
    # One partition order, so that the same rows give the same forest.
    model = forest.fit(inputs.transform(rows.orderBy(order, "found", "before", "after")))
    return PipelineModel([inputs, model])


def findings(docs: DataFrame, model: PipelineModel | float, threshold: float = 0.5, rows: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_key, ordinal, start, n_chars, score, is_secret) of every candidate."""
    rows = with_features(candidates(docs)) if rows is None else rows
    if isinstance(model, float):
        rows = rows.withColumn("score", F.lit(model))
    else:
        rows = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return rows.select(
        "doc_id", "text_key", "ordinal", "start", F.col("n_chars").cast("bigint").alias("n_chars"), "score",
        (F.col("score") >= threshold).alias("is_secret"),
    )


def scan(docs: DataFrame) -> DataFrame:
    """``findings`` of ``docs``, judged by a forest that learned from those of its candidates that are beyond doubt."""
    rows = written(with_features(candidates(docs)), "candidates")
    return findings(docs, fit_forest(weak_labels(rows)), rows=rows)


def redacted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs``, all rows and columns, with every secret of ``found`` replaced; texts without one are returned as they are."""
    own_id, own_key, own = unused(docs, "secret_id", "secret_key", "secret_ordinals")
    secret = found.where("is_secret").groupBy("doc_id", "text_key").agg(F.collect_set("ordinal").alias(own))
    secret = secret.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), own)
    rows = docs.join(secret, F.col("doc_id").cast("bigint").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.col("text").cast("string")) == F.col(own_key)), "left")
    text = F.col("text").cast("string")
    parts, cut = F.split(text, CANDIDATE, -1), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    put = F.transform(cut, lambda x, i: F.concat(F.get(parts, i), F.when(F.array_contains(own, i), REPLACEMENT).otherwise(x)))
    whole = F.concat(F.array_join(put, ""), F.element_at(parts, -1))
    kept = [F.when(F.col(own).isNull(), F.col("text")).otherwise(whole).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*kept)
