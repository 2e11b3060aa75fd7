"""Secret scans with a random forest; DataFrame, SQL and ML functions of the JVM only.

Candidates are runs of 16 or more characters of keys (letters, digits, + / _ -) with a digit among them, and any value, of whatever
length and signs up to the next space or quote, that is assigned to a word which names secrets. What a candidate looks
like and what stands around it become features: its length, how its character classes change, how much of it is words that the
corpus uses, the path, and the neighbouring words. The forest, trained from labelled findings, tells secrets from numbers, names
and links.

Training takes at most `SAMPLE` labelled findings of each class, in the order of a hash. Candidates are searched in all lines of all texts.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from quillbank.llm.frames import cut

SAMPLE = 10_000
TREES = 20
DEPTH = 6
SEED = 7
THRESHOLD = 0.5

# No pattern repeats a group without a bound, which Java matches by recursion, and none starts anew inside a run that it has
# already read to the end: time is linear and the stack flat, however long a value, a word or a line is.
RUN = r"[A-Za-z0-9+/_-]{16,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}"
# Words that name secrets, and parts of paths where findings are seldom real.
KEY_WORDS = r"(?i)(^|[^a-z])(passw(or)?d|pwd|passphrase|secret|token|api_?key|access_?key|private_?key|auth|bearer|credentials?|key)([^a-z]|$)"
_KEY = r"(?:passw(?:or)?d|pwd|passphrase|secret|token|api_?key|access_?key|private_?key|auth|authorization|bearer|credentials?|key)"
#: A whole name of letters, digits and . _ - with a word that names secrets in it, and quotes or a bracket behind it.
_NAME = rf"(?<![a-z0-9_.-])(?=(?:[a-z0-9_.-]*?[0-9_.-])?{_KEY})[a-z0-9_.-]*+[\"'\]]*+"
ASSIGNED = rf"(?i){_NAME}(?::=|=>|[=:])[\"'`]*+([^\s\"'`]+)"
NAMES_VALUE = rf"(?i){_NAME}\s*+(?::=|=>|[=:])$"
#: Formats of keys by which their issuers know them.
ISSUED = "^(" + "|".join((
    "(AKIA|ASIA)[0-9A-Z]{16}", "gh[pousr]_[A-Za-z0-9]{36,}", "github_pat_[A-Za-z0-9_]{22,}", "glpat-[A-Za-z0-9_-]{20,}", "[sr]k_(live|test)_[A-Za-z0-9]{16,}",
    "whsec_[A-Za-z0-9+/=]{20,}", "xox[abeprs]-[A-Za-z0-9-]{10,}", "AIza[A-Za-z0-9_-]{35}", "ya29[.][A-Za-z0-9_-]{20,}", "npm_[A-Za-z0-9]{36}",
    "pypi-[A-Za-z0-9_-]{32,}", "SG[.][A-Za-z0-9_-]{16,}[.][A-Za-z0-9_-]{16,}", "sk-[A-Za-z0-9_-]{20,}", "hf_[A-Za-z0-9]{30,}",
    "dop_v1_[0-9a-f]{64}", "shp(at|ca|pa|ss)_[0-9a-fA-F]{32}", "eyJ[A-Za-z0-9_-]{8,}([.][A-Za-z0-9_-]+){0,2}",
)) + ")$"
#: Values that are no keys: numbers, ids of the UUID kind, references to where a value is; `no_key` adds words joined by signs.
NO_KEY = "^(" + "|".join((
    "[0-9/_+-]+",
    "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[$%][({]?[A-Za-z_][A-Za-z0-9_.]*[)}%]?", "[<{].*[>}]", r"(?i)(true|false|null|none|nil)[,;]?",
)) + ")$"
PIECE = "^([a-z]+[0-9]{0,4}|[0-9]{1,8})$"
QUIET_PATHS = r"(?i)(^|[/_.-])(tests?|examples?|samples?|docs?|fixtures?|mocks?)([/_.-]|$)"

FEATURES = [
    "length", "transitions", "digit_share", "upper_share", "lower_share", "distinct_share", "hex", "coverage", "quiet_path", "path_depth",
    "key_before", "assigned", "quoted", "key_after", "wordy_neighbours",
]


def candidates(documents: DataFrame) -> DataFrame:
    """One row for each candidate of `documents` (doc_id, path, text): where it stands, its value and its neighbours in the line."""
    lines = documents.select("doc_id", F.coalesce("path", F.lit("")).alias("path"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    named = F.col("line").rlike(rf"(?i){_KEY}") & F.col("line").rlike("[=:]")
    found = lines.where(F.col("line").rlike(CANDIDATE) | named)
    found = found.withColumn("words", F.regexp_extract_all("line", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    at = lambda n: F.coalesce(F.get("words", F.col("word_no") + n), F.lit(""))
    found = found.select("doc_id", "path", "line_no", "words", F.posexplode("words").alias("word_no", "word"))
    found = found.select(
        "doc_id", "path", "line_no", "word_no", "word", F.concat_ws(" ", at(-3), at(-2), at(-1)).alias("before"), F.concat_ws(" ", at(1), at(2)).alias("after"),
    )
    # A value assigned within the word, or the whole word behind a name with a sign of assignment; brackets and stops behind it aside.
    inside = F.regexp_extract("word", ASSIGNED, 1)
    whole = F.when(F.col("before").rlike(NAMES_VALUE) & ~F.col("word").rlike("^[=:]+$"), F.regexp_extract("word", "^[\"'`]*([^\"'`]+)", 1)).otherwise("")
    found = found.withColumn("given", F.regexp_replace(F.when(inside != "", inside).otherwise(whole), r"[,;)\]]+$", ""))
    runs = F.filter(F.regexp_extract_all("word", F.lit(RUN), F.lit(0)), lambda r: r.rlike("[0-9]"))
    positions = F.filter(F.transform(F.regexp_extract_all("word", F.lit(RUN), F.lit(0)), lambda r, k: F.struct(k.alias("part"), r.alias("value"))), lambda r: r.value.rlike("[0-9]"))
    # Runs that are pieces of the assigned value are not shown beside it; the value has the part behind the last run.
    known = F.array_contains(runs, F.col("given")) | (F.col("given") == "")
    apart = F.filter(positions, lambda r: ~F.contains(F.col("given"), r.value))
    last = F.size(F.regexp_extract_all("word", F.lit(RUN), F.lit(0)))
    shown = F.when(known, positions).otherwise(F.concat(apart, F.array(F.struct(last.alias("part"), F.col("given").alias("value")))))
    found = found.withColumn("shown", F.explode(shown))
    return found.select("doc_id", "path", "line_no", "word_no", "word", "before", "after", "shown.part", "shown.value")


def _letters(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0))


def known_words(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Which of the letter runs in candidates and their neighbours are words of the corpus: (run, seen), seen in so many documents."""
    runs = found.select(F.explode(F.array_union(_letters(F.col("value")), _letters(F.concat_ws(" ", "before", "after")))).alias("run"))
    spoken = documents.select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("run"))
    # Counted in each task first: what is shuffled are distinct words, so a frequent one is no hot key of the join.
    counted = spoken.where(F.length("run") > 2).groupBy("run").agg(F.count("*").alias("seen")).where("seen > 1")
    return counted.join(cut(runs.distinct()), "run", "left_semi")


def describe(documents: DataFrame) -> DataFrame:
    """The candidates of `documents` with the columns of `FEATURES`, doubles without nulls."""
    found = cut(candidates(documents).withColumn("finding", F.xxhash64("doc_id", "path", "line_no", "word_no", "part", "word", "before", "after")))
    spoken = known_words(documents, found)
    parts = found.select("finding", F.explode(F.array_union(
        F.transform(_letters(F.col("value")), lambda r: F.struct(F.lit(True).alias("inside"), r.alias("run"))),
        F.transform(_letters(F.concat_ws(" ", "before", "after")), lambda r: F.struct(F.lit(False).alias("inside"), r.alias("run"))),
    )).alias("p")).select("finding", "p.inside", "p.run").distinct()
    spoken = parts.join(spoken, "run").groupBy("finding").agg(
        F.sum(F.when(F.col("inside"), F.length("run")).otherwise(0)).alias("covered"), F.sum(F.when(~F.col("inside"), 1).otherwise(0)).alias("near")
    )
    value, size = F.col("value"), F.length("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    share = lambda pattern: F.length(F.regexp_replace(value, pattern, "")) / size
    head = F.expr("substring_index(word, value, 1)")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    described = found.join(spoken, "finding", "left").select(
        "finding", "doc_id", "path", "line_no", "word_no", "part", "value", "word", "before", "after",
        size.cast("double").alias("length"), ((F.length(F.regexp_replace(kinds, r"(.)\1*", "x")) - 1) / size).alias("transitions"),
        share("[^0-9]").alias("digit_share"), share("[^A-Z]").alias("upper_share"), share("[^a-z]").alias("lower_share"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct_share"), flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex"),
        (F.coalesce("covered", F.lit(0)) / size).alias("coverage"), flag(F.col("path").rlike(QUIET_PATHS)).alias("quiet_path"),
        (F.size(F.split("path", "/")) - 1).cast("double").alias("path_depth"),
        flag(F.concat_ws(" ", "before", head).rlike(KEY_WORDS)).alias("key_before"), flag(F.concat_ws(" ", "before", head).rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        flag(head.rlike("[\"']$")).alias("quoted"), flag(F.col("after").rlike(KEY_WORDS)).alias("key_after"),
        F.coalesce("near", F.lit(0)).cast("double").alias("wordy_neighbours"),
    )
    return cut(described)


def train(labelled: DataFrame, sample: int = SAMPLE) -> PipelineModel | float:
    """A forest from described findings with a `label` of 0 or 1; findings of other labels are left out.

    With findings of one class only there is nothing to learn: the result is that class as a constant score (0 without findings).
    """
    sides = [labelled.where(F.col("label") == side).orderBy(F.xxhash64("finding", F.lit(SEED)), "finding").limit(sample) for side in (0, 1)]
    rows = cut(sides[0].union(sides[1]).select("finding", *FEATURES, F.col("label").cast("double").alias("label")).coalesce(1).sortWithinPartitions("finding"))
    present = {r.label for r in rows.select("label").distinct().collect()}
    if len(present) < 2:
        return float(max(present, default=0.0))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label", maxMemoryInMB=64)
    return PipelineModel([assembler, forest.fit(assembler.transform(rows))])


def judge(described: DataFrame, model: PipelineModel | float) -> DataFrame:
    """Adds `score`, from 0 to 1, and `secret`, true from 0.5."""
    if isinstance(model, float):
        scored = described.withColumn("score", F.lit(model))
    else:
        scored = model.transform(described).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
    return scored.withColumn("secret", F.col("score") >= THRESHOLD)


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def no_key(value: Column) -> Column:
    """A value that is no key by its form: one of `NO_KEY`, or words and small numbers joined by signs, a word first."""
    pieces = F.split(F.regexp_replace(value, "^[/_+-]+|[/_+-]+$", ""), "[/_+-]+")
    return value.rlike(NO_KEY) | (F.size(pieces) > 1) & F.get(pieces, F.lit(0)).rlike("^[a-z]+[0-9]{0,4}$") & F.forall(pieces, lambda p: p.rlike(PIECE))


def issued_format() -> Column:
    """Labels for a corpus without reviewed findings: 1 for a value in the format of an issuer of keys, and for a hexadecimal value
    assigned to a word that names a secret; 0 for what is no key by its form; null, which training leaves out, for all others."""
    named = F.concat_ws(" ", "before", F.expr("substring_index(word, value, 1)")).rlike(r"(?i)(passw(or)?d|token|secret|api_?key)[\"']?\s*[=:]\s*[\"']?$")
    value = F.col("value")
    return F.when(value.rlike(ISSUED) | named & value.rlike("^[0-9a-f]{16,}$"), 1).when(no_key(value), 0)


def scan(documents: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """All candidates of `documents` (doc_id, path, text) with their features, score and verdict.

    `labels` has reviewed findings (doc_id, line_no, word_no, part, label); without it, `issued_format` labels the candidates
    outside of the held-out rows. Null and empty texts have no candidates; a null path counts as empty; repeated rows give
    repeated findings.
    """
    described = describe(documents.select("doc_id", "path", "text"))
    if labels is None:
        labelled = described.where(~held_out(F.col("doc_id"))).withColumn("label", issued_format())
    else:
        labelled = described.join(labels.select("doc_id", "line_no", "word_no", "part", "label"), ["doc_id", "line_no", "word_no", "part"])
    return judge(described, train(labelled, sample))
