"""Secret scan: a random forest over candidate strings removes false positives.

Candidates are runs of at least 16 characters that secrets are made of, with or without a digit, and
of any length and punctuation the values after names of secrets (``password = ...``, to the closing
quote, or without quotes to the next blank, less a full stop, comma, semicolon or closing bracket at
the end) and the passwords of ``scheme://user:password@host``. Each is described by

* its length, its share of digits, capitals, vowels and other signs, and whether it is a plain word
  or a placeholder;
* character transitions: how often the kind of character changes, how many transitions are rare in
  words (a consonant run, a digit between letters), and its number of distinct characters;
* dictionary coverage: the part of it made of common words and word endings;
* its path: the source the document comes from, by the words in it (test, example, config ...);
* neighbouring words: words before it that name secrets (key, token ...) or harmless numbers (commit,
  sha256, uuid ...), the sign before it, quotes around it.

The forest is trained on labelled findings: a table (candidate, before, after, path, label).
``labelled_findings`` makes such a table by rule, of fixed size, with positives and hard negatives;
any other of the same columns can be used. Everything on the way from texts to findings is DataFrame
expressions and JVM trees.

Findings carry positions and a hash, never the secret. ``redacted`` replaces secrets in the texts.

Cases: null and empty text have no findings; very long texts are read whole; a document with very
many candidates is many rows, not one; repeated rows give findings each; an empty table gives no
rows; extra columns are ignored by ``findings`` and kept by ``redacted``; null sources are an empty
path.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import keeps_columns

AROUND = 48  # characters of context on either side
THRESHOLD = 0.5
FINDINGS = 6_000  # labelled findings made by rule
TREES, DEPTH, SEED = 40, 8, 11
MARK = "[SECRET]"

# Words that name secrets, words that name harmless strings, words of paths.
NAMES_SECRET = "api[_-]?key|apikey|token|secret|passw|credential|auth|bearer|private|access[_-]?key"
# what stands before a named value: the name, its quote, the sign, a quote
NAMED = rf"(?i:{NAMES_SECRET})[A-Za-z0-9_\-]{{0,24}}[\"'`\])]{{0,2}}[ \t]{{0,4}}[:=]{{1,2}}>?[ \t]{{0,4}}"
LOGIN = r"://[^\s/:@\"'<>]{0,128}:"
CANDIDATE = (
    rf"(?<=[:=>][ \t]{{0,4}}[\"'`])(?:(?<={NAMED}\")[^\"\r\n]+(?=\")|(?<={NAMED}')[^'\r\n]+(?=')|(?<={NAMED}`)[^`\r\n]+(?=`))"
    rf"|(?<=[:=>][ \t]{{0,4}})(?<={NAMED})(?![:=>])[^\s\"'`]*[^\s\"'`,;.)\]}}]"
    rf"|(?<=:)(?<={LOGIN})[^\s/\"'<>]+(?=@)"
    r"|(?<![A-Za-z0-9_+/\-])[A-Za-z0-9_+/\-]{16,}={0,2}"
)
NAMES_HARMLESS = "commit|sha1|sha256|md5|digest|checksum|hash|uuid|guid|revision|integrity|etag|id"
PATH_HARMLESS = "test|example|sample|mock|fixture|doc"
PATH_CONFIG = "config|env|settings|deploy|secret"
WORDS = (
    "about access account after also and are been before build cache class client code common config "
    "content data default demo document example file for from group have image index item key library "
    "line list local main message model module name number object order other package page public "
    "release request result sample server service source string system table test text that the their "
    "this time token type update user value version was were when which will with word work world your"
)


def _any(words: str) -> str:
    return rf"(?i)(?<![a-z])(?:{words})"


def features() -> dict[str, Column]:
    """Numbers describing candidate, before, after and path."""
    text = F.col("candidate")
    length = F.greatest(F.length(text), F.lit(1)).cast("double")
    before, path = F.col("before"), F.lower(F.coalesce("path", F.lit("")))
    bare = F.regexp_replace(text, "=+$", "")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    changes = count(r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])")
    # how often each character occurs, for the spread of characters
    characters = F.split(bare, "")
    distinct = F.size(F.array_distinct(characters)).cast("double")
    covered = length - F.length(
        F.regexp_replace(text, "(?i)" + "|".join(sorted(WORDS.split(), key=len, reverse=True)), "")
    )
    return {
        "length": length,
        "digits": count("[0-9]") / length,
        "capitals": count("[A-Z]") / length,
        "signs": count(r"[_+/=\-]") / length,
        "punctuation": count(r"[^A-Za-z0-9_+/=\-\s]") / length,
        "blanks": count(r"\s") / length,
        "vowels": count("(?i)[aeiou]") / length,
        "kinds": sum(F.when(text.rlike(k), 1.0).otherwise(0.0) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")),
        "word": F.when(text.rlike(r"^\p{L}?[\p{Ll}\s]+[.!?]?$") | text.rlike(r"^\p{Lu}+$"), 1.0).otherwise(0.0),
        "placeholder": F.when(text.rlike(r"^(?:[$%<{\[(].*|.*[>})\]]|[*.xX\-_/+]+)$"), 1.0).otherwise(0.0),
        "named": F.when(before.rlike(NAMED + "[\"'`]?$"), 1.0).otherwise(0.0),
        "login": F.when(before.rlike(LOGIN + "$"), 1.0).otherwise(0.0),
        "hex": F.when(text.rlike(r"^[0-9a-f]+$") | text.rlike(r"^[0-9A-F]+$"), 1.0).otherwise(0.0),
        "uuid": F.when(text.rlike(r"(?i)^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$"), 1.0).otherwise(0.0),
        "numeric": F.when(text.rlike(r"^[0-9+\-/]+$"), 1.0).otherwise(0.0),
        "transitions": changes / length,
        "digit_inside": count("(?<=[A-Za-z])[0-9](?=[A-Za-z])") / length,
        "consonants": count("(?i)[bcdfghjklmnpqrstvwxz]{4,}") / length,
        "distinct": distinct / F.least(length, F.lit(40.0)),
        "runs": count(r"(.)\1{2,}"),
        "known_prefix": F.when(text.rlike(r"^(?:AKIA|ASIA|gh[pousr]_|sk_live_|sk-|xox[abprs]-|AIza|eyJ)"), 1.0).otherwise(0.0),
        "covered": covered / length,
        "path_harmless": F.when(path.rlike(PATH_HARMLESS), 1.0).otherwise(0.0),
        "path_config": F.when(path.rlike(PATH_CONFIG), 1.0).otherwise(0.0),
        "slashes": count("/"),
        "near_secret": F.when(before.rlike(_any(NAMES_SECRET) + r"[^\s]*\s*\S{0,3}\s*\S?$"), 1.0).otherwise(0.0),
        "near_harmless": F.when(before.rlike(_any(NAMES_HARMLESS) + r"[^\s]*\s*\S{0,3}\s*\S?$"), 1.0).otherwise(0.0),
        "assigned": F.when(before.rlike(r"[=:]\s*[\"'`]?$"), 1.0).otherwise(0.0),
        "quoted": F.when(before.rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]"), 1.0).otherwise(0.0),
        "in_url": F.when(before.rlike(r"(?i)(?:https?://|www\.)\S*$"), 1.0).otherwise(0.0),
    }


def labelled_findings(spark: SparkSession, size: int = FINDINGS) -> DataFrame:
    """(candidate, before, after, path, label): secrets and look-alikes in their usual places."""
    row = F.col("id")

    def random(name: str) -> Column:
        return F.sha2(F.concat(F.lit(name), row.cast("string")), 256)

    def pick(name: str, values: list[str]) -> Column:
        at = F.conv(F.substring(random(name), 1, 6), 16, 10).cast("long") % len(values) + 1
        return F.element_at(F.array(*map(F.lit, values)), at.cast("int"))

    hexed = F.concat(random("a"), random("b"))
    based = F.regexp_replace(F.base64(F.unhex(hexed)), "=", "")
    urls = F.translate(based, "+/", "-_")
    length = pick("n", ["20", "24", "32", "36", "40", "44", "48", "64"]).cast("int")
    word = pick("w", WORDS.split())
    words = F.concat_ws("-", word, pick("v", WORDS.split()), pick("u", WORDS.split()), pick("t", WORDS.split()), F.substring(random("y"), 1, 1), (row % 90 + 10).cast("string"))
    letters = F.translate(based, "0123456789+/", "qWxZvKjBgYtR")
    sign = pick("z", list("!@#$%&*?.:;~^"))
    leet = F.translate(F.initcap(F.concat(word, pick("v", WORDS.split()))), "oeas", "0345")
    password = F.when(row % 3 == 0, F.concat(F.substring(leet, 1, 9), sign, F.substring(based, 1, 3), F.lit("!"))).when(
        row % 3 == 1, F.concat(F.substring(based, 1, 4), sign, F.substring(letters, 5, 4), pick("m", list("!#&$%+")), F.substring(hexed, 1, 2))
    ).otherwise(F.concat(F.substring(leet, 1, 8), sign))
    joined = F.concat(pick("v", WORDS.split()), pick("u", WORDS.split()), pick("t", WORDS.split()), pick("w2", ["ation", "ungen", "ements", "alization", "schaften", "lichkeit", "schtz"]))
    names = ["NAME", "TOKEN", "PASSWORD", "API_KEY", "SECRET", "VALUE"]
    secret = pick("s", ["hex40", "hex", "base", "url", "akia", "ghp", "sk", "letters", "akia letters", "password", "login", "slack", "web token", "word digits"])
    lure = pick("l", ["hash", "uuid", "words", "number", "path", "filler", "inline", "long", "plain", "identifier", "placeholder", "joined", "capitals", "capitals"])
    good = row % 2 == 0
    candidate = (
        F.when(good & (secret == "hex40"), F.substring(hexed, 1, 40))
        .when(good & (secret == "hex"), F.expr("substring(hexed, 1, length)"))
        .when(good & (secret == "base"), F.expr("substring(based, 1, length)"))
        .when(good & (secret == "url"), F.expr("substring(urls, 1, length)"))
        .when(good & (secret == "akia"), F.concat(F.lit("AKIA"), F.upper(F.substring(random("k"), 1, 16))))
        .when(good & (secret == "ghp"), F.concat(F.lit("ghp_"), F.expr("substring(replace(replace(based, '+', 'p'), '/', 'q'), 1, 36)")))
        .when(good & (secret == "letters"), F.expr("substring(translate(based, '0123456789+/', 'qWxZvKjBgYtR'), 1, length)"))
        .when(good & (secret == "akia letters"), F.concat(F.lit("AKIA"), F.upper(F.substring(letters, 1, 16))))
        .when(good & (secret == "slack"), F.concat(F.when(row % 3 == 0, F.lit("sk-proj-")).otherwise(F.concat(F.lit("xoxb-"), (row * 7919 % 10**9 + 10**11).cast("string"), F.lit("-"))), F.expr("substring(urls, 1, 32)")))
        .when(good & (secret == "web token"), F.concat(F.lit("eyJ"), F.expr("substring(urls, 1, length)")))
        .when(good & (secret == "word digits"), F.concat(word, F.lower(F.substring(letters, 1, 2)), (row % 997).cast("string")))
        .when(good & secret.isin("password", "login"), F.when(secret == "password", password).otherwise(F.translate(password, "@", "!")))
        .when(good, F.concat(F.lit("sk_live_"), F.expr("substring(replace(replace(based, '+', 'p'), '/', 'q'), 1, 24)")))
        .when(lure == "hash", F.expr("substring(hexed, 1, if(id % 4 = 1, 40, 64))"))
        .when(lure == "uuid", F.expr("concat_ws('-', substring(hexed, 1, 8), substring(hexed, 9, 4), substring(hexed, 13, 4), substring(hexed, 17, 4), substring(hexed, 21, 12))"))
        .when(lure == "words", words)
        .when(lure == "number", F.expr("substring(translate(hexed, 'abcdef', '012345'), 1, if(id % 4 = 1, 16, 20))"))
        .when(lure == "path", F.concat(F.lit("usr/"), F.replace(words, F.lit("-"), F.lit("/"))))
        .when(lure == "filler", F.concat(F.repeat(pick("f", ["x", "0", "X", "a1"]), 12), F.lit("00000000")))
        .when(lure == "inline", F.expr("substring(urls, 1, length)"))
        .when(lure == "plain", F.when(row % 4 == 1, word).when(row % 8 == 3, F.initcap(word)).otherwise(F.concat_ws(" ", F.initcap(word), pick("v", WORDS.split()), pick("u", WORDS.split()))))
        .when(lure == "identifier", F.when(row % 4 == 1, F.concat_ws("_", pick("v", WORDS.split()), pick("u", WORDS.split()), word, pick("t", WORDS.split()))).otherwise(F.replace(F.initcap(F.concat_ws(" ", pick("v", WORDS.split()), pick("u", WORDS.split()), word, pick("t", WORDS.split()))), F.lit(" "))))
        .when(lure == "placeholder", F.when(row % 8 == 1, F.concat(F.lit("${"), pick("v", names), F.lit("}"))).when(row % 8 == 3, F.concat(F.lit("<your-"), word, F.lit(">"))).when(row % 8 == 5, pick("v", ["None", "null", "true", "false", "********", "xxxxxxxx", "os.environ", "getpass()", "10", "3600"])).otherwise(F.repeat(pick("f", ["-", "_", "/", "+-"]), 24)))
        .when(lure == "capitals", F.upper(F.concat(pick("v", WORDS.split()), F.when(row % 3 == 0, F.lit("-")).otherwise(""), pick("u", WORDS.split()), pick("t", WORDS.split()), pick("w2", ["ation", "ungen", "keit", "alization", "schaften", "s"]))))
        .when(lure == "joined", F.when(row % 4 == 1, F.initcap(joined)).otherwise(joined))
        .otherwise(F.concat(word, pick("v", WORDS.split()), pick("u", WORDS.split()), F.lit("2"), word))
    )
    said = pick("b", ["api_key = ", "token = ", "secret: ", "password=", "auth_token: ", "access_key = ", "credentials ", "bearer "])
    plain = pick("p", ["commit ", "sha256: ", "md5 ", "checksum=", "uuid: ", "id = ", "see ", "the file ", "order number ", "and then ", "revision ", "card ", "token = ", "key: "])
    plain = F.when(lure.isin("hash", "number", "uuid"), pick("q", ["commit ", "sha256: ", "md5 ", "checksum=", "uuid: ", "id = ", "revision ", "digest: ", "number "])).when(
        lure == "inline", pick("q", ["https://img.example.com/", "http://www.example.org/p/", "https://cdn.example.net/static/"])
    ).otherwise(plain)
    said = F.when(secret == "login", pick("b", ["postgres://app:", "https://user:", "mysql://root:", "ftp://anna:", "amqp://a.b:"])).when(
        secret.isin("password", "word digits"), pick("b", ["password = ", "passwd: ", "DB_PASSWORD=", "secret: ", "userPassword: ", "token="])
    ).when(secret.isin("letters", "akia letters") & (row % 3 == 0), pick("b", ["key=", "key: ", "KEY = ", "access key id: "])).otherwise(said)
    plain = F.when(lure.isin("plain", "placeholder") | ((lure == "capitals") & (row % 4 == 1)), pick("q", ["author: ", "password: ", "token = ", "secret: ", "private: ", "auth=", "API_KEY=", "tokens: "])).otherwise(plain)
    bare = secret.isin("base", "url", "slack", "web token") & (row % 3 == 1)  # nothing around tells
    said = F.when(bare, pick("b", ["use ", "see ", "then ", "and the ", "it was ", "here: "])).otherwise(said)
    quote = pick("o", ['"', "'", "", '"'])
    quoted = F.when(good & (secret == "login"), "").when(good, quote).otherwise(F.when(lure == "inline", "").otherwise(pick("o", ["", "", '"', ""])))
    path = F.when(
        good, pick("h", ["src/config/app.env", "deploy/settings.py", "src0", "notes.txt", "web/main.js"])
    ).otherwise(pick("h", ["tests/test_app.py", "docs/example.md", "src0", "notes.txt", "web/main.js"]))
    made = spark.range(0, size, 1, 1).select(
        "id", hexed.alias("hexed"), based.alias("based"), urls.alias("urls"), length.alias("length")
    )
    return made.select(
        candidate.alias("candidate"),
        F.concat(pick("c", ["so the ", "", "in this ", "export "]), F.when(good, said).otherwise(plain), quoted).alias("before"),
        F.when(good & (secret == "login"), "@db.example.com/x").otherwise(F.concat(quoted, F.lit(" and more"))).alias("after"),
        path.alias("path"),
        good.cast("double").alias("label"),
    )


def train(labelled: DataFrame) -> PipelineModel:
    """The forest, from labelled findings."""
    described = features()
    rows = labelled.select("label", *[v.alias(k) for k, v in described.items()])
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features")
    return Pipeline(stages=[VectorAssembler(inputCols=list(described), outputCol="features"), forest]).fit(rows)


def candidates(documents: DataFrame, extra: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per candidate: ``extra``, path, at (its number), start, candidate, before, after.

    The text is cut at the candidates; a candidate's start is the running length of what precedes,
    over the thin rows of its document.
    """
    found = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    between = F.split(F.col("text"), CANDIDATE, -1)
    rows = documents.where(F.col("text").rlike(CANDIDATE)).select(
        *extra, F.coalesce("source", F.lit("")).alias("path"), found.alias("found"), between.alias("between"),
        F.monotonically_increasing_id().alias("row"),
    )
    zipped = F.zip_with(
        "found",
        F.arrays_zip(
            F.transform(F.slice("between", F.lit(1), F.size("found")), lambda x, i: F.struct(F.length(x).alias("n"), F.right(F.concat(F.coalesce(F.get("found", i - 1), F.lit("")), x), F.lit(AROUND)).alias("before"))).alias("b"),
            F.transform(F.slice("between", F.lit(2), F.size("found")), lambda x: F.left(x, F.lit(AROUND))).alias("after"),
        ),
        lambda c, x: F.struct(c.alias("candidate"), x["b"]["n"].alias("n"), x["b"]["before"].alias("before"), x["after"].alias("after")),
    )
    each = rows.select(*extra, "path", "row", F.posexplode(zipped).alias("at", "c")).select(
        *extra, "path", "row", "at", "c.*"
    )
    order = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("n") + F.length("candidate")).over(order)
    return each.withColumn("start", ends - F.length("candidate")).drop("n", "row")


def scored(found: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``score``, the share of trees' votes for a secret."""
    described = features()
    rows = found.select("*", *[v.alias(f"{k}") for k, v in described.items()])
    out = model.transform(rows)
    return out.select(*found.columns, vector_to_array("probability")[1].alias("score"))


def findings(documents: DataFrame, model: PipelineModel) -> DataFrame:
    """(doc_id, start, length, sha256, score, is_secret) of every candidate."""
    out = scored(candidates(documents), model)
    return out.select(
        "doc_id",
        F.col("start").cast("long").alias("start"),
        F.length("candidate").cast("long").alias("length"),
        F.sha2(F.col("candidate").cast("binary"), 256).alias("sha256"),
        "score",
        (F.col("score") >= THRESHOLD).alias("is_secret"),
    )


@keeps_columns
def redacted(documents: DataFrame, model: PipelineModel) -> DataFrame:
    """``documents`` with every secret replaced by ``MARK`` and ``n_chars`` counted anew.

    Only documents with a secret meet their findings: by text hash and source, on which the decision
    depends; the others pass through.
    """
    key = F.md5(F.col("text").cast("binary"))
    marked = candidates(documents.withColumn("_key", key), ("_key",))
    secret = scored(marked, model).where(F.col("score") >= THRESHOLD)
    flags = secret.groupBy("_key", "path").agg(F.array_sort(F.collect_set("at")).alias("_at"))
    has = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    rows = documents.withColumn("_key", key).withColumn("_path", F.coalesce("source", F.lit("")))
    clean, some = rows.where(~has), rows.where(has)
    joined = some.alias("d").join(
        flags.alias("f"), (F.col("d._key") == F.col("f._key")) & (F.col("d._path") == F.col("f.path")), "left"
    ).select("d.*", "_at")
    found = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    between = F.split(F.col("text"), CANDIDATE, -1)
    kept = F.transform(found, lambda c, i: F.when(F.array_contains("_at", i), F.lit(MARK)).otherwise(c))
    text = F.concat(
        F.array_join(F.zip_with(F.slice(between, F.lit(1), F.size(found)), kept, lambda a, b: F.concat(a, b)), ""),
        F.element_at(between, -1),
    )
    new = F.when(F.col("_at").isNull(), F.col("text")).otherwise(text)
    changed = joined.withColumn("text", new)
    columns = [f"`{c}`" for c in documents.columns]
    every = changed.select(*columns).unionByName(clean.select(*columns))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        every = every.withColumn("n_chars", F.length("text").cast(kind)).select(*columns)
    return every
