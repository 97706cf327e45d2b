"""Secret scans with a random forest that removes false positives (operator 2).

A candidate is a run of at least ``MIN_LENGTH`` characters of ``[A-Za-z0-9+/_-]`` (with base64 padding) anywhere in a word, and
whatever its signs the value of at least ``MIN_VALUE`` characters after ``=``, ``:`` or a quote, in the same word or in the next one (a
run inside such a value is no candidate of its own).  The forest sees its length, shares of character classes, transitions between
classes and between vowels and consonants, the part that dictionary words cover, signs of a path, address or url, and the words beside
it.  It is trained on labelled findings (``findings``: candidate, its context, 1 for a secret); the candidates that it takes for secrets are returned.

The query's labelled findings: secrets of known forms planted beside real words of a drawn sample (hex and base64 of hashes,
key identifiers, short ones, ones of letters alone and ones with other signs), with and without telling neighbours; and, as false positives,
the sample's own candidates of letters alone, numbers, paths, versions, dates, addresses and words that are assigned or quoted.  The sample is about
``TRAIN_DOCS`` documents, drawn by hash whatever the size of the corpus.  The dictionary holds the letter runs that make up at least
``LEAST_SHARE`` of all letter runs of all documents (so never more than ``1 / LEAST_SHARE``).

All of it is DataFrame functions and spark.ml (JVM) stages; the driver gets the forest and the dictionary.

Cases: a null or empty text has no candidates; equal rows are found alike; a null doc_id is reported as null; texts are taken whole, a
long run is one candidate; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import named, stored

MIN_LENGTH, MIN_VALUE, TRAIN_DOCS, LEAST_SHARE, LEAST = 12, 8, 400, 1e-3, 0.5
TREES, TREE_DEPTH, SEED = 24, 8, 17
_RUN = rf"([A-Za-z0-9+/_\-]{{{MIN_LENGTH},}}(?:={{1,2}}(?![A-Za-z0-9=]))?)"
_IN_VALUE = r"""[^\s"'`<>()\[\]{},;=:]"""
_VALUE = rf"""[=:"'`]((?!//){_IN_VALUE}{{{MIN_VALUE},}})"""
_NEXT = rf"""^((?!\w*://){_IN_VALUE}{{{MIN_VALUE},}})"""
_CONTEXT = r"(?i)(key|token|secret|passw|pwd|passphrase|auth|bearer|credential|api)"
#: Used if a sample has no words.
_COMMON = ["the", "and", "ing", "ion", "ent"]


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, place, candidate, context): place is the word's number, context the two words before and what precedes in the word."""
    own = docs.select(named(doc_id).alias("doc_id"), F.split(named(text), r"[\x20\x09-\x0D]+").alias("w"))
    none = F.array().cast("array<string>")

    def found_in(word: Column, i: Column) -> Column:
        assigned = F.coalesce(F.get("w", i - 1).rlike("[=:]$"), F.lit(False))
        runs = F.when((F.length(word) >= MIN_LENGTH) & word.rlike(_RUN), F.regexp_extract_all(word, F.lit(_RUN), 1)).otherwise(none)
        values = F.when((F.length(word) > MIN_VALUE) & word.rlike(_VALUE), F.regexp_extract_all(word, F.lit(_VALUE), 1)).otherwise(none)
        following = F.when(assigned & (F.length(word) >= MIN_VALUE) & word.rlike(_NEXT), F.regexp_extract_all(word, F.lit(_NEXT), 1)).otherwise(none)
        values = F.transform(F.concat(values, following), lambda v: F.regexp_replace(v, "[.!?]+$", ""))
        return F.struct(i.alias("place"), word.alias("word"), runs.alias("runs"), F.filter(values, lambda v: F.length(v) >= MIN_VALUE).alias("values"))

    at = F.filter(F.transform("w", found_in), lambda x: (F.size(x["runs"]) > 0) | (F.size(x["values"]) > 0))
    found = own.select("doc_id", "w", F.explode(at).alias("at"))
    alone = F.filter("at.runs", lambda r: ~F.exists("at.values", lambda v: F.contains(v, r)))
    found = found.withColumn("candidate", F.explode(F.array_distinct(F.concat("at.values", alone))))
    before = F.when(F.col("at.place") > 0, F.concat_ws(" ", F.expr("slice(w, greatest(at.place - 1, 1), least(at.place, 2))"))).otherwise(F.lit(""))
    ahead = F.expr("substring(at.word, 1, locate(candidate, at.word) - 1)")
    return found.select("doc_id", F.col("at.place").alias("place"), "candidate", F.concat(before, F.lit(" "), ahead).alias("context"),
                        F.expr("substring(at.word, locate(candidate, at.word) + length(candidate), 8)").alias("behind"))


def _features(c: Column, context: Column, behind: Column, dictionary: list[str]) -> dict[str, Column]:
    n = F.length(c).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    low = F.lower(c)
    return {
        "length": n, "digits": share("[0-9]"), "upper": share("[A-Z]"), "lower": share("[a-z]"), "hex": share("[0-9a-fA-F]"),
        "to_digit": share("[A-Za-z](?=[0-9])"), "from_digit": share("[0-9](?=[A-Za-z])"), "to_upper": share("[a-z](?=[A-Z])"), "to_lower": share("[A-Z](?=[a-z])"),
        "to_vowel": share("(?i)[b-df-hj-np-tv-z](?=[aeiou])"), "from_vowel": share("(?i)[aeiou](?=[b-df-hj-np-tv-z])"), "repeated": share(r"(.)(?=\1)"),
        "covered": 1 - F.length(F.regexp_replace(low, "|".join(dictionary), "")) / n,
        "marks": share("[^A-Za-z0-9+/_=-]"), "slashes": share("/"), "dashes": share("[-_]"), "path": context.rlike(r"[/@.\\]$").cast("double"), "address": behind.rlike("^[@.]").cast("double"),
        "named": context.rlike(_CONTEXT).cast("double"), "assigned": context.rlike("[=:][\\s\"'`]*$").cast("double"), "quoted": context.rlike("[\"'`]$").cast("double"),
        "closed": behind.rlike("^[\"'`]").cast("double"),
    }


def featured(rows: DataFrame, dictionary: list[str]) -> DataFrame:
    columns = _features(F.col("candidate"), F.col("context"), F.col("behind"), dictionary)
    wide = rows.select("*", *(c.alias(f"f_{k}") for k, c in columns.items()))
    return VectorAssembler(inputCols=[f"f_{k}" for k in columns], outputCol="features").transform(wide).drop(*(f"f_{k}" for k in columns))


def sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = TRAIN_DOCS) -> DataFrame:
    """About ``most`` documents, drawn by a hash of their texts."""
    share = most / max(docs.count(), 1)
    return docs.select(named(doc_id).alias("doc_id"), named(text).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)


def dictionary_of(docs: DataFrame, text: str = "text", least: float = LEAST_SHARE) -> list[str]:
    """The letter runs of 3 to 8 letters that are at least ``least`` of all such runs, counted over all documents."""
    runs = docs.select(F.explode(F.regexp_extract_all(F.lower(named(text)), F.lit("([a-z]{3,8})"), 1)).alias("run"))
    counts = stored(runs.groupBy("run").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    frequent = counts.filter(F.col("count") >= least * total).collect()  # 1 / least rows at most
    return sorted((r["run"] for r in frequent), key=lambda x: (-len(x), x)) or _COMMON


def planted_findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(candidate, context, behind, label): labelled findings from a sample of documents."""
    real = candidates(docs, doc_id, text)
    seed = F.md5(F.concat_ws("|", "candidate", "place"))
    other = F.sha2(F.concat(seed, F.lit("x")), 256)
    raw = F.regexp_replace(F.base64(F.unhex(other)), "[^A-Za-z0-9+/]", "")
    pick = F.pmod(F.xxhash64("candidate", "place"), F.lit(8))
    kind = F.pmod(F.xxhash64("candidate", "place", F.lit(9)), F.lit(10))
    letters = F.translate(other, "0123456789", "ghjkqvwxyz")
    upper = F.translate(other, "0123456789abcdef", "GHJKQVWXYZabcdef")
    signed = F.concat(F.substring(raw, 1, 4), F.substring(F.lit("!#&@%*"), F.pmod(F.xxhash64("place"), F.lit(6)).cast("int") + 1, F.lit(1)), F.substring(raw, 5, 4))
    # these look like secrets only where they are assigned or quoted
    short = (F.when(kind == 0, F.substring(raw, 1, 8)).when(kind == 1, F.substring(raw, 1, 10)).when(kind == 2, F.substring(letters, 1, 14))
             .when(kind == 3, F.substring(upper, 1, 20)).when(kind == 4, signed).when(kind == 5, F.concat(signed, F.lit("$"), F.substring(raw, 9, 6)))
             .when(kind == 6, F.concat(F.initcap(F.substring(F.regexp_replace(F.lower("candidate"), "[^a-z]", ""), 1, 6)), F.lit("&"), F.substring(seed, 1, 4)))
             .when(kind == 7, F.substring(seed, 1, 9)).when(kind == 8, F.concat(F.substring(raw, 1, 9), F.lit("!"))).otherwise(F.substring(upper, 1, 11)))
    secret = (F.when(pick == 0, F.substring(F.concat(seed, other), 1, 40)).when(pick == 1, F.substring(seed, 1, 18)).when(pick == 2, seed)
              .when(pick == 3, F.substring(raw, 1, 40)).when(pick == 4, F.substring(raw, 1, 24)).when(pick == 5, F.concat(F.lit("AKIA"), F.upper(F.substring(other, 1, 16))))
              .when(pick == 6, F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(raw, "[+/]", ""), 1, 30))).otherwise(other))
    way = F.pmod(F.xxhash64("place", "candidate", F.lit(3)), F.lit(5))
    lead = (F.when(way == 0, F.concat("context", F.lit(' token = "'))).when(way == 1, F.concat("context", F.lit(" password="))).when(way == 2, F.concat("context", F.lit("api_key: ")))
            .when(way == 3, F.concat("context", F.lit(" secret: '"))).otherwise(F.concat("context", F.lit('"'))))
    secrets = real.select(secret.alias("candidate"), lead.alias("context"), F.when(way.isin(0, 4), F.lit('"')).when(way == 3, F.lit("'")).otherwise(F.lit("")).alias("behind"), F.lit(1.0).alias("label"))
    named_lead = (F.when(way == 0, F.concat("context", F.lit(' token = "'))).when(way == 1, F.concat("context", F.lit(" password=")))
                  .when(way == 2, F.concat("context", F.lit(" api_key: \""))).when(way == 3, F.concat("context", F.lit(" pwd = \""))).otherwise(F.concat("context", F.lit(" passwd: "))))
    shorts = real.select(short.alias("candidate"), named_lead.alias("context"), F.when(way.isin(0, 2, 3), F.lit('"')).otherwise(F.lit("")).alias("behind"), F.lit(1.0).alias("label"))
    words = real.filter(~F.col("candidate").rlike("[0-9]")).select("candidate", "context", "behind", F.lit(0.0).alias("label"))
    number = F.translate(seed, "abcdef", "012345")
    word = F.regexp_replace(F.lower("candidate"), "[^a-z]", "")
    wrong = (F.when(pick == 0, F.substring(number, 1, 16)).when(pick == 1, F.concat(word, F.lit("/"), F.substring(word, 1, 6), F.lit("/"), F.substring(number, 1, 3)))
             .when(pick == 2, F.concat(F.lit("2024-0"), F.substring(number, 1, 1), F.lit("-1"), F.substring(number, 2, 1), F.lit("T10"))).when(pick == 3, F.concat(F.substring(word, 1, 10), F.lit("_"), F.substring(number, 1, 4)))
             .when(pick == 4, F.concat(F.initcap(F.substring(word, 1, 7)), F.initcap(F.substring(word, 4, 9)))).when(pick == 5, F.concat(F.lit("section-"), word, F.lit("-"), F.substring(number, 1, 2)))
             .when(pick == 6, F.concat(F.substring(number, 1, 4), F.lit("-"), F.substring(number, 5, 4), F.lit("-"), F.substring(number, 9, 4))).otherwise(F.upper(word)))
    # false positives stand beside telling words as well
    beside = F.when(way == 0, F.concat("context", F.lit(" key: "))).when(way == 1, F.concat("context", F.lit(" path="))).otherwise(F.col("context"))
    plain = F.when(pick < 4, F.substring(word, 1, 9)).when(pick < 6, word).otherwise(F.concat(F.substring(word, 1, 8), F.lit("'s")))
    said = (F.when(way == 0, F.concat("context", F.lit(' title="'))).when(way == 1, F.concat("context", F.lit(" note: "))).when(way == 2, F.concat("context", F.lit(' "')))
            .when(way == 3, F.concat("context", F.lit(" password: "))).otherwise(F.concat("context", F.lit(" name="))))
    quoted = real.filter(F.length(word) >= MIN_VALUE).select(plain.alias("candidate"), said.alias("context"), F.when(way.isin(0, 2), F.lit('"')).otherwise(F.lit("")).alias("behind"), F.lit(0.0).alias("label"))
    false = real.select(wrong.alias("candidate"), beside.alias("context"), "behind", F.lit(0.0).alias("label"))
    long = secrets.unionByName(words).unionByName(false).filter(F.length("candidate") >= MIN_LENGTH)
    return long.unionByName(shorts.unionByName(quoted).filter(F.length("candidate") >= MIN_VALUE))


def fit(findings: DataFrame, dictionary: list[str]) -> RandomForestClassificationModel:
    """A forest from labelled findings (candidate, context, behind, label); in one partition and order, so reruns agree."""
    rows = featured(findings.select("candidate", "context", "behind", F.col("label").cast("double").alias("label")), dictionary)
    rows = rows.repartition(1).sortWithinPartitions("label", "candidate", "context", "behind")
    return RandomForestClassifier(numTrees=TREES, maxDepth=TREE_DEPTH, seed=SEED, maxMemoryInMB=64).fit(rows)


def scan(docs: DataFrame, model: RandomForestClassificationModel, dictionary: list[str], doc_id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """(doc_id, place, candidate, context, probability): the candidates that the forest takes for secrets."""
    scored = model.transform(featured(candidates(docs, doc_id, text), dictionary)).withColumn("probability", vector_to_array("probability")[1])
    return scored.filter(F.col("probability") >= least).select(F.col("doc_id").alias(doc_id), "place", "candidate", "context", "probability")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    drawn = stored(sample(docs))
    dictionary = dictionary_of(docs)
    found = scan(docs, fit(stored(planted_findings(drawn)), dictionary), dictionary)
    return found.select("doc_id", F.col("place").cast("bigint").alias("place"), F.length("candidate").cast("bigint").alias("length"),
                        F.sha2("candidate", 256).alias("candidate_sha256"), F.round("probability", 4).alias("probability"))
