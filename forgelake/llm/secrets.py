"""Secret scans: candidate strings, and a random forest that removes false positives; DataFrame operations only.

Candidates are white-space words that hold a run of at least LEAST characters of a key
alphabet with a digit in it. The forest (Spark ML) sees the candidate's length, its transitions between
character classes, how much of it dictionary words cover, whether it or its origin looks
like a path, and the words before it. It learns from labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.llm.shared import cut_lineage, tune

LEAST = 12
#: Labelled findings that the forest learns from, chosen by a hash.
SAMPLE = 4000
TREES, DEPTH = 24, 6
#: Words that tell a secret or a harmless value, and words that make up placeholders and names.
TELLING = ["password", "passwd", "pwd", "secret", "token", "key", "apikey", "api_key", "auth", "bearer", "credential", "credentials"]
HARMLESS = ["sha", "sha1", "sha256", "md5", "hash", "commit", "checksum", "digest", "uuid", "id", "version", "build", "order", "invoice", "card", "phone", "tel"]
DICTIONARY = ["example", "sample", "test", "dummy", "placeholder", "changeme", "your", "here", "user", "name", "mail", "com", "net", "org", "www", "http", "https", "file", "path", "home", "src", "lib", "data", "version", "page", "item", "value", "password", "token", "secret", "key"]
#: Formats that are secrets beyond doubt, and that are not.
CERTAIN = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk_live_[0-9A-Za-z]{24,}|xox[abprs]-[0-9A-Za-z-]{10,})$"
BENIGN = r"^([0-9.+-]+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+)$"
_RUN = rf"[A-Za-z0-9+/_=.@-]{{{LEAST},}}"
FEATURES = ["length", "digits", "uppers", "lowers", "transitions", "longest_letters", "hex", "covered", "pathlike", "origin_path", "telling", "harmless", "assigned"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """doc_id, at (number of the word), candidate, before (the two words before), path."""
    words = F.split(F.col(text_col), r"[\x20\x09-\x0D]+")
    numbered = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda x: (F.length(x["word"]) >= LEAST) & x["word"].rlike(_RUN) & x["word"].rlike("[0-9]"))
    # No look-ahead over whole runs here: a long run without a digit would cost the square of its length.
    rows = docs.where(F.col(text_col).rlike(_RUN) & F.col(text_col).rlike("[0-9]"))
    path = F.lit(None).cast("string") if path_col is None else F.col(path_col).cast("string")
    rows = rows.select(F.col(id_col).alias("doc_id"), path.alias("path"), words.alias("words"))
    found = rows.select("doc_id", "path", "words", F.explode(numbered).alias("x"))
    before = F.array_join(F.slice("words", F.greatest(F.col("x.at") - 1, F.lit(1)), F.least(F.col("x.at"), F.lit(2))), " ")
    value = F.explode(F.filter(F.regexp_extract_all("word", F.lit(_RUN), F.lit(0)), lambda v: v.rlike("[0-9]")))
    split = found.select("doc_id", "path", F.col("x.at").alias("at"), F.col("x.word").alias("word"), F.when(F.col("x.at") > 0, F.lower(before)).otherwise("").alias("before"))
    # What stands in front of a run inside its own word, as in password=..., counts as a word before it.
    split = split.select("doc_id", "path", "at", "before", "word", value.alias("run"))
    value = F.regexp_replace("run", r"^[A-Za-z_]+=|(?<![.=@/+-])[.=@/+-]+$", "")
    own = F.lower(F.concat_ws(" ", "before", F.regexp_extract("run", r"^([A-Za-z_]+)=", 1), F.regexp_extract("word", r"^([A-Za-z_]+)[:=\"']", 1)))
    return split.select("doc_id", "at", value.alias("candidate"), own.alias("before"), "path").where(F.length("candidate") >= LEAST)


def _any(words: list[str]) -> Column:
    return F.col("before").rlike(rf"(^|[^a-z0-9_])({'|'.join(words)})($|[^a-z0-9_])").cast("double")


def with_features(found: DataFrame) -> DataFrame:
    v = F.col("candidate")
    count = lambda pattern: F.regexp_count(v, F.lit(pattern)).cast("double")
    covered = F.aggregate(F.regexp_extract_all(F.lower("candidate"), F.lit(rf"({'|'.join(sorted(DICTIONARY, key=len, reverse=True))})"), F.lit(0)), F.lit(0.0), lambda total, w: total + F.length(w))
    longest = F.aggregate(F.regexp_extract_all("candidate", F.lit("[A-Za-z]+"), F.lit(0)), F.lit(0.0), lambda top, w: F.greatest(top, F.length(w).cast("double")))
    length = F.length(v).cast("double")
    return found.withColumns({
        "length": length, "digits": count("[0-9]") / length, "uppers": count("[A-Z]") / length, "lowers": count("[a-z]") / length,
        "transitions": (count("[a-z](?=[A-Z0-9])") + count("[A-Z](?=[a-z0-9])") + count("[0-9](?=[A-Za-z])")) / length, "longest_letters": longest,
        "hex": v.rlike("^[0-9a-f]+$").cast("double"), "covered": covered / length, "pathlike": v.rlike(r"/|\.[a-z]{2,4}$").cast("double"),
        "origin_path": F.coalesce(F.col("path").rlike(r"(?i)(test|example|fixture|mock)").cast("double"), F.lit(0.0)),
        "telling": _any(TELLING), "harmless": _any(HARMLESS), "assigned": F.col("before").rlike(r"[=:]\s*[\"']?\s*$|\w =").cast("double"),
    })


def labelled(found: DataFrame) -> DataFrame:
    """Findings whose label is beyond doubt: a certain format, or a value assigned to a telling name, against benign formats."""
    v = F.col("candidate")
    secret = v.rlike(CERTAIN) | ((F.col("telling") == 1) & v.rlike("[0-9]") & ~v.rlike(BENIGN) & (F.col("covered") < 0.5))
    harmless = v.rlike(BENIGN) | (F.col("covered") >= 0.5) | (F.col("harmless") == 1)
    return found.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0)).where("label is not null")


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, at, candidate, before, probability of each finding that the forest keeps.

    `known` holds labelled findings (candidate, before, path, label); without it they are
    taken from the candidates whose label is beyond doubt. At most SAMPLE of each label are
    learned from. If there is only one label, candidates of a certain format are returned
    with probability 1. Null and empty texts have no candidates; rows with a null or
    repeated id are scanned like any other; `path_col` may be null.
    """
    tune(docs.sparkSession)
    found = cut_lineage(with_features(candidates(docs, id_col, text_col, path_col)), "candidates")
    known = labelled(found) if known is None else with_features(known)
    mixed = known.select(*FEATURES, "label", F.xxhash64("candidate", "before").alias("h")).distinct()
    sample = cut_lineage(mixed.where("label = 1").orderBy("h").limit(SAMPLE).unionByName(mixed.where("label = 0").orderBy("h").limit(SAMPLE)), "labelled")
    out = ["doc_id", "at", "candidate", "before"]
    if sample.select("label").distinct().count() < 2:
        return found.where(F.col("candidate").rlike(CERTAIN)).select(*out, F.lit(1.0).alias("probability"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=7).fit(assembler.transform(sample))
    scored = forest.transform(assembler.transform(found)).withColumn("probability", vector_to_array("probability")[1])
    return scored.where(F.col("probability") >= threshold).select(*out, "probability")
