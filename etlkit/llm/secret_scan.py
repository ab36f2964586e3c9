"""Secret scans: candidates by pattern, false positives removed by a random forest. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etlkit.llm.common import materialize
from etlkit.llm.secret_labels import labelled_findings
from etlkit.runtime import require

# Names of credentials, where a value is given to them.
_GIVEN = (
    r"(?i:token|secret|passwd|password|passphrase|pwd|key|credentials?|auth|authorization|value)[\"']?\s{0,2}(?:=>?|:)\s{0,2}"
)
# Private key blocks, user and password of URLs, web tokens of three parts, values of 8 or more characters given to a
# credential's name (quoted or bare), and runs of 16 or more key characters with a digit among them.
CANDIDATE = (
    r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}+-----END (?:[A-Z]+ )*PRIVATE KEY-----"
    r"|(?<=://)[^\s/:@\"']{1,64}:[^\s/:@\"']{6,}(?=@)"
    r"|\beyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]+|\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"
    rf"|(?<=[\"'])(?<={_GIVEN}[\"'])[^\s\"']{{8,}}(?=[\"'])"
    rf"|(?<=[=:>\s])(?<={_GIVEN})[^\s\"'`<>,;&(){{}}\[\]]{{8,}}"
    r"|(?<![A-Za-z0-9_+/\-])(?=[A-Za-z_+/\-]*[0-9])[A-Za-z0-9_+/\-]{16,}={0,2}"
)
SHORTEST = 8
# Words that often stand beside a credential, and words that secrets do not spell.
NEIGHBOURS = (
    r"(?i)(token|secret|passw|password|passphrase|pwd|api_?-?key|apikey|access_?-?key|private|private_?-?key|credentials?|bearer"
    r"|authori[sz]ation|auth(?!or))"
)
# Forms that issuers give their keys.
KNOWN = (
    r"^(eyJ[\w\-]+\.[\w\-]+\.[\w\-]+|(AKIA|ASIA)[0-9A-Z]{16}|gh[opsur]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w\-]{20,}"
    r"|xox[abeprs]-[\w\-]{10,}|AIza[\w\-]{35}|[rs]k_(live|test)_[A-Za-z0-9]{16,})$|^-----BEGIN "
)
DICTIONARY = (
    "the", "and", "for", "with", "this", "that", "from", "test", "example", "sample", "dummy", "file", "page", "index",
    "image", "http", "https", "www", "html", "content", "article", "number", "order", "date", "time", "name", "user",
    "value", "data", "table", "version", "license", "public", "section", "chapter", "item", "list", "text", "your", "here",
    "change", "insert", "placeholder", "password", "secret", "token", "none", "null",
)
TEST_PATH = r"(?i)(test|example|sample|mock|fixture|demo|docs?/)"
BEFORE, AFTER = 48, 16
FEATURES = (
    "n_chars", "digit_share", "upper_share", "other_share", "distinct_share", "switches", "case_switches", "longest_letters",
    "longest_digits", "is_hex", "is_digits", "word_share", "test_path", "path_depth", "near_keyword", "assigned", "quoted",
    "before_letters", "after_letters", "bearer", "known_form", "in_url", "marked",
)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _starts(lengths: Column) -> Column:
    """Sum of all lengths before each, by sums of stretches of 256, so that long texts take about linear time."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda t, n: t + n)
    stretches = F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor(F.size(lengths) / 256).cast("int")), lambda c: total(F.slice(lengths, c * 256 + 1, 256)))
    before = lambda sums: F.transform(sums, lambda _, c: total(F.slice(sums, 1, c)))
    place = lambda sums: F.transform(lengths, lambda _, i: sums[F.floor(i / 256).cast("int")] + total(F.slice(lengths, i - i % 256 + 1, i % 256)))
    return _bound(_bound(stretches, before), place)


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """``(doc_id, path, value, start, before, after)``: each candidate of a text at each of its places."""
    require(docs, doc_id, text, path)
    body = F.col(text)
    found = F.struct(F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)).alias("v"), F.split(body, CANDIDATE, -1).alias("p"))

    def at(i: Column, s: Column, starts: Column) -> Column:
        # So many values of the least length fill the text before a place, or after it.
        piece = lambda a, k: F.coalesce(F.get(a, k), F.lit(""))
        prior = F.concat(*[piece(s[n], i - k) for k in range(BEFORE // SHORTEST, 0, -1) for n in ("p", "v")], piece(s["p"], i))
        after = F.concat(*[piece(s[n], i + k) for k in range(1, AFTER // SHORTEST + 1) for n in ("p", "v")])
        return F.struct(
            F.get(s["v"], i).alias("value"), (F.get(starts, i) + F.char_length(piece(s["p"], i)) + 1).alias("start"),
            F.right(prior, F.lit(BEFORE)).alias("before"), F.left(after, F.lit(AFTER)).alias("after"))

    def places(s: Column) -> Column:
        lengths = F.transform(s["v"], lambda v, i: F.char_length(v) + F.char_length(F.get(s["p"], i)))
        return _bound(_bound(lengths, _starts), lambda starts: F.transform(s["v"], lambda _, i: at(i, s, starts)))

    got = docs.select(F.col(doc_id).alias("doc_id"), F.col(path).cast("string").alias("path"), F.explode(_bound(found, places)).alias("f"))
    return got.select("doc_id", "path", "f.*")


def with_features(found: DataFrame) -> DataFrame:
    """Length, character transitions, dictionary coverage, path and neighbouring words of findings, as numbers."""
    v, n, before, after = F.col("value"), F.length("value"), F.col("before"), F.col("after")
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    longest = lambda pattern: F.coalesce(F.array_max(F.transform(F.regexp_extract_all(v, F.lit(pattern), F.lit(0)), F.length)), F.lit(0)).cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    path = F.coalesce("path", F.lit(""))
    columns = {
        "n_chars": n.cast("double"), "digit_share": count(v, "[0-9]") / n, "upper_share": count(v, "[A-Z]") / n,
        "other_share": count(v, "[^A-Za-z0-9]") / n, "distinct_share": F.size(F.array_distinct(F.split(v, ""))) / n,
        "switches": (count(v, "[A-Za-z](?=[0-9])") + count(v, "[0-9](?=[A-Za-z])")) / n, "case_switches": count(v, "[a-z](?=[A-Z])") / n,
        "longest_letters": longest("[A-Za-z]+"), "longest_digits": longest("[0-9]+"), "is_hex": flag(v.rlike("^[0-9a-fA-F]+$")),
        "is_digits": flag(v.rlike("^[0-9_+/-]+$")), "word_share": 1 - F.length(F.regexp_replace(F.lower(v), "|".join(DICTIONARY), "")) / n,
        "test_path": flag(path.rlike(TEST_PATH)), "path_depth": count(path, "/"), "near_keyword": flag(before.rlike(NEIGHBOURS + r"[\w-]*\W*$")),
        "assigned": flag(before.rlike(r"[=:]>?\s*[\"'`]?$")), "quoted": flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "before_letters": F.length(F.regexp_extract(before, r"(\p{L}*)\P{L}*$", 1)).cast("double"),
        "after_letters": F.length(F.regexp_extract(after, r"^\P{L}*(\p{L}*)", 1)).cast("double"),
        "bearer": flag(before.rlike(r"(?i)\bbearer\s+$")), "known_form": flag(v.rlike(KNOWN)),
        "in_url": flag(before.endswith("://")), "marked": count(v, r"[^A-Za-z0-9_+/=\-]"),
    }
    return found.withColumns(columns)


def known_findings(spark: SparkSession, **options) -> DataFrame:
    """Findings with features and ``label`` in the labelled texts of ``secret_labels``."""
    texts = materialize(labelled_findings(spark, **options), "secret-labels")
    found = findings(texts, "doc_id", "text", "path")
    marks = texts.select("doc_id", F.col("value").alias("__value"), "label")
    return with_features(found.join(marks, "doc_id").filter(F.contains("value", "__value") | F.contains("__value", "value")).drop("__value"))


def scored_findings(featured: DataFrame, labelled: DataFrame, rows: int = 5_000, trees: int = 40, depth: int = 10, seed: int = 1) -> DataFrame:
    """``featured`` with ``probability`` and ``is_secret``, by a forest fitted on at most ``rows`` labelled findings.

    ``labelled`` has the feature columns, ``doc_id``, ``value`` and ``label``. The bound and the order of
    a hash make the forest the same for any layout of the table. With labels of one kind only, or none,
    every finding has that kind's probability; without any label every candidate counts as a secret.
    """
    key = F.xxhash64("doc_id", "value", "start")
    sample = materialize(labelled.select("label", *FEATURES, key.alias("__h")).orderBy("__h", *FEATURES).limit(rows).drop("__h"), "secret-sample")
    seen = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        rate = float(next(iter(seen), 1.0))
        return featured.withColumn("probability", F.lit(rate)).withColumn("is_secret", F.lit(rate >= 0.5))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="__x", handleInvalid="keep")
    forest = RandomForestClassifier(featuresCol="__x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, probabilityCol="__p", rawPredictionCol="__r", predictionCol="__y")
    model = forest.fit(assembler.transform(sample.coalesce(1)))
    out = model.transform(assembler.transform(featured))
    out = out.withColumn("probability", vector_to_array("__p")[1]).withColumn("is_secret", F.col("probability") >= 0.5)
    return out.drop("__x", "__p", "__r", "__y")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", labelled: DataFrame | None = None, **options) -> DataFrame:
    """``(doc_id, value, start, n_chars, probability, is_secret)`` of every place of every candidate of every row.

    ``probability`` is that of the place; a value is a secret in all its places in the rows of an id if
    it is in one. Whole texts are searched; null and empty texts have no candidates. Repeated rows give repeated
    findings. ``labelled`` are reviewed findings (``doc_id``, ``value``, ``label``) of these rows; without them the forest is
    fitted on the labelled texts of ``secret_labels``. The forest alone judges. Extra columns play no part. An empty table gives no rows.
    """
    featured = materialize(with_features(findings(docs, doc_id, text, path)), "findings")
    if labelled is None:
        known = known_findings(docs.sparkSession)
    else:
        marks = labelled.select("doc_id", "value", F.col("label").cast("double").alias("label")).distinct()
        known = featured.join(marks, ["doc_id", "value"])
    found = scored_findings(featured, known, **options)
    found = materialize(found, "scored-findings")
    secret = found.filter("is_secret").select(F.col("doc_id").alias("__d"), F.col("value").alias("__v")).distinct()
    found = found.join(secret, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("value") == F.col("__v")), "left")
    found = found.withColumn("is_secret", F.col("__v").isNotNull())
    return found.select("doc_id", "value", "start", F.col("n_chars").cast("int").alias("n_chars"), "probability", "is_secret")


def redacted(docs: DataFrame, text: str = "text", path: str = "source", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every place of each found secret in its row's text replaced by ``mark``.

    Columns and rows stay; ``n_chars``, where there is one, follows the text. Rows are told apart by their text, so
    a secret of one row changes no other text, whatever ids they have or lack. Reviewed labels have the text's md5 as ``doc_id``.
    """
    keyed = docs.select(F.md5(text).alias("__key"), F.col(text).alias(text), F.col(path).alias(path))
    found = scan(keyed, "__key", text, path, **options).filter("is_secret")
    # Longer values first, so that a secret that holds another is taken out whole.
    longest_first = F.array_sort(F.collect_set(F.struct((-F.length("value")).alias("k"), F.col("value").alias("v"))))
    lists = found.groupBy(F.col("doc_id").alias("__owner")).agg(longest_first.alias("__secrets"))
    lists = materialize(lists, "secret-lists")
    out = docs.join(lists, F.md5(text) == F.col("__owner"), "left")
    clean = F.aggregate("__secrets", F.col(text), lambda t, s: F.replace(t, s["v"], F.lit(mark)))
    out = out.withColumn(text, F.when(F.col("__secrets").isNull(), F.col(text)).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__secrets").isNull(), F.col("n_chars")).otherwise(F.char_length(text).cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
