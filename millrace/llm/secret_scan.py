"""Secret scans with a random forest against false positives.

Patterns find candidates: all long runs of key characters, whatever is assigned
to a secret's name, passwords within URLs, and the lines of private keys.  A
forest of Spark's ML library, trained on labelled findings, tells secrets from
numbers, paths, identifiers, checksums and placeholders by the candidate's
length, character transitions, dictionary coverage, path and neighbours.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import SPACE_SEPARATOR, text_key, written

#: A candidate: a whole run of key characters, 16 or more with a digit among them, or 20 or more with
#: letters of both halves of the alphabet, which leaves out rules and one letter over and over.
CANDIDATE = r"(?<![A-Za-z0-9_+/-])(?:(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+|(?=[n-zN-Z_+/-]*+[a-mA-M])(?=[a-mA-M_+/-]*+[n-zN-Z])[A-Za-z0-9_+/-]{20,}+)={0,2}"
#: Labelled findings that the built-in training set has, and by default at most learns from.
TRAINING_ROWS = 6_000

# Words of keys' names, of what isn't a key, and of identifiers and paths.
SECRET_NAMES = "token secret key apikey api_key passwd password pwd auth authorization bearer credential credentials private access".split()
OTHER_NAMES = "commit checksum sha sha1 sha256 md5 hash uuid guid order card number isbn phone invoice example sample dummy placeholder test version build revision etag digest file path".split()
DICTIONARY = (
    "account address admin after api app application array backup base before build cache "
    "class client code common config connection count create data database date debug default delete "
    "dev directory document download email end error event example export fake field file find folder format from get group "
    "handler home html http https id image import index info input install insert item java key library line "
    "link list local log login manager map master message method model module name network new node not number "
    "object option order package page param parse password path placeholder product project "
    "python query read record release request response result run sample script search secret select server service "
    "session set setting share site size source start status string style system table tag target temp "
    "test text time title token tool type update upload url user value window with "
    "word work write your"
).split()

SYLLABLES = "an and ar ba by con cor den dis ent er for gra ing ist ka ker lan less lo ma men mi nor ob out per pre qui ra ri sal sen sto tal ter tion tri un ven ver vo way wi".split()

_NAME = "(?:token|secret|key|passwd|password|pwd|auth|authorization|bearer|credentials?|private|access)"
_QUOTE = r"""[\\"'`]{0,2}"""
_SIGN = rf"{_QUOTE}(?:[=:]|:=|==|=>|::){_QUOTE}"
_SCHEME = "(?:bearer|basic|token)"
#: A text that may hold a value of a secret's name.
NAMED = rf"(?i){_NAME}{_QUOTE}\s*[=:]"
#: Words after which a word is such a value.
NAMED_BEFORE = rf"(?i)(?:{_NAME}{_QUOTE} ?{_SIGN[len(_QUOTE):]}|authorization{_QUOTE} ?[=:]+ ?{_QUOTE}{_SCHEME})$"
#: A run of CANDIDATE, or a value of any length behind a name and a sign, up to a run of CANDIDATE.
VALUE = rf"""(?<=(?i:{_NAME}){_SIGN})(?!(?i:{_SCHEME})(?:\W|$))(?:(?!{CANDIDATE})[^\x20\x09-\x0D\\"'`,;&<>(){{}}\[\]|])+"""
#: A text or word that may hold a password in a URL, and that password, up to a run of CANDIDATE; users of up to 256 characters.
URL = r"://[^\x20\x09-\x0D/:@]*+:[^\x20\x09-\x0D/@]++@"
PASSWORD = rf"(?<=:)(?<=://[^\x20\x09-\x0D/:@]{{0,256}}:)(?=[^\x20\x09-\x0D/@]++@)(?:(?!{CANDIDATE})[^\x20\x09-\x0D/@])+"
FOUND = f"{CANDIDATE}|{PASSWORD}|{VALUE}"
#: A private key's first line; and that with up to 16 lines of headers, where nothing but key lines follows up to the last one,
#: or a key line behind such a match, each with the blanks before the next key line.
KEY_BLOCK = r"-----BEGIN [A-Z0-9 ]{0,64}PRIVATE KEY(?: BLOCK)?-----"
KEY_LINES = (
    rf"({KEY_BLOCK}(?:[ \t\r]*\n[A-Za-z-]+: [^\n]*+){{0,16}}(?=[A-Za-z0-9+/=\s]*+-----END )|\G(?!\A)[A-Za-z0-9+/=]++)"
    r"(\s++)(?=[A-Za-z0-9+/]++={0,2}\s)"
)
#: Stands before a word whose name and sign are in the words before it.
_MARK = "key="

FEATURES = [
    "length", "digits", "capitals", "letters", "distinct", "transitions", "hex", "dictionary", "slashes", "url",
    "extension", "named", "named_near", "other_near", "assigned", "quoted", "one_char", "separators", "consonants", "userinfo", "block",
]


def _any_of(names: list[str]) -> str:
    return r"(?i)(?<![a-z])(" + "|".join(names) + r")(?![a-z])"


def candidates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text_key, place, nth, candidate, word, prefix, before, near, after, key_line) and ``keep``: what the patterns find.

    ``place`` is the word's place and ``nth`` the candidate's within the word, both from 0; ``prefix``
    is what stands between the candidate before, or the word's start, and this one, and ``word`` that,
    the candidate and what follows up to the next.  ``before`` is the word before the first candidate
    of a word, ``near`` the three before, or the candidate before and its prefix, and ``after`` the
    two words after the last.  ``key_line`` says that the word is a line of a private key, from its BEGIN
    line to its END line; such words are candidates of any length.
    """
    split = lambda text: F.array_remove(F.split(text, SPACE_SEPARATOR), "")
    # Each line of a key gets a sign in front, so the words that differ from the text's own are its lines.
    signed = F.when(F.col("text").rlike(KEY_BLOCK), split(F.regexp_replace("text", KEY_LINES, "$1$2#")))
    found = documents.select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"), *keep
    ).filter(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(NAMED) | F.col("text").rlike(URL) | F.col("text").rlike(KEY_BLOCK))
    found = found.select("doc_id", "text_key", *keep, split(F.col("text")).alias("w"), signed.alias("signed"))
    word = lambda i, k: F.coalesce(F.when(i + k >= 0, F.get(F.col("w"), i + F.lit(k))), F.lit(""))
    assigned = lambda i: word(i, -1).rlike(rf"(?i)(?:[=:>][\\\"'`]{{0,2}}|{_SCHEME})$") & F.concat_ws(" ", word(i, -2), word(i, -1)).rlike(NAMED_BEFORE)
    block = lambda i: F.coalesce(F.get("signed", i) != word(i, 0), F.lit(False))
    in_url = lambda i: word(i, 0).contains("://") & word(i, 0).rlike(URL)
    places = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0))),
        lambda i: ((F.length(word(i, 0)) >= 16) & word(i, 0).rlike(CANDIDATE)) | word(i, 0).rlike(NAMED) | in_url(i) | block(i) | assigned(i),
    )
    found = found.withColumn("places", places)
    each = F.transform(
        "places",
        lambda i: F.struct(
            i.alias("place"),
            F.concat(F.when(assigned(i) | block(i), _MARK).otherwise(""), word(i, 0)).alias("marked"),
            (assigned(i) | block(i)).alias("assigned"),
            block(i).alias("key_line"),
            word(i, -1).alias("before"),
            F.concat_ws(" ", word(i, -3), word(i, -2), word(i, -1)).alias("near"),
            F.concat_ws(" ", word(i, 1), word(i, 2)).alias("after"),
        ),
    )
    found = found.select("doc_id", "text_key", *keep, each.alias("each"))
    found = found.select("doc_id", "text_key", *keep, F.explode_outer("each").alias("x")).filter(F.col("x").isNotNull())
    # What the pattern matches and what is between, so that runs of equal text keep their own places.
    found = found.select(
        "doc_id", "text_key", *keep, "x", F.regexp_extract_all("x.marked", F.lit(FOUND), F.lit(0)).alias("runs"), F.split("x.marked", FOUND, -1).alias("gaps")
    )
    bare = lambda gap, j: F.when((j == 0) & F.col("x.assigned"), F.substr(gap, F.lit(len(_MARK) + 1))).otherwise(gap)
    gap = lambda j: F.get(F.col("gaps"), j)
    inner = F.transform(
        "runs",
        lambda run, j: F.struct(
            j.alias("nth"),
            F.concat(bare(gap(j), j), run, gap(j + 1)).alias("word"),
            bare(gap(j), j).alias("prefix"),
            F.when(j == 0, F.col("x.before")).otherwise("").alias("before"),
            F.when(j == 0, F.col("x.near")).otherwise(F.concat(bare(gap(j - 1), j - 1), F.get(F.col("runs"), j - 1))).alias("near"),
            F.when(j == F.size("runs") - 1, F.col("x.after")).otherwise("").alias("after"),
            run.alias("candidate"),
            F.col("x.key_line").alias("key_line"),
        ),
    )
    found = found.select("doc_id", "text_key", *keep, "x.place", F.explode_outer(inner).alias("y")).filter(F.col("y").isNotNull())
    return found.select("doc_id", "text_key", *keep, "place", "y.*")


def features(found: DataFrame) -> DataFrame:
    """Adds the columns FEATURES, all numbers."""
    c, n = F.col("candidate"), F.length("candidate")
    left = lambda pattern: F.length(F.regexp_replace(c, pattern, ""))
    share = lambda pattern: (n - left(pattern)) / n
    runs = F.size(F.regexp_extract_all(c, F.lit(r"[0-9]+|[a-z]+|[A-Z]+|[^0-9a-zA-Z]+"), F.lit(0)))
    yes = lambda column: column.cast("double")
    prefix = F.col("prefix")
    name = F.concat_ws(" ", F.col("near"), prefix)
    columns: dict[str, Column] = {
        "length": n.cast("double"),
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "letters": share("[A-Za-z]"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "transitions": (runs - 1) / n,
        "hex": yes(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "dictionary": share("(?i)" + "|".join(sorted(DICTIONARY, key=len, reverse=True))),
        "slashes": (n - left("/")).cast("double"),
        "url": yes(F.col("word").rlike("(?i)(https?:|www\\.|@)")),
        "extension": yes(F.col("word").rlike(r"\.[a-z]{1,5}\W*$") | F.col("word").rlike(r"^[./~]")),
        "named": yes(F.concat_ws(" ", "before", prefix).rlike(_any_of(SECRET_NAMES))),
        "named_near": yes(name.rlike(_any_of(SECRET_NAMES))),
        "other_near": yes(F.concat_ws(" ", name, "after").rlike(_any_of(OTHER_NAMES))),
        "assigned": yes(prefix.rlike("[=:]") | F.col("before").rlike("[=:]$")),
        "quoted": yes(prefix.rlike("[\"'`]$")),
        "one_char": F.length(F.regexp_extract(c, r"(.)\1{3,}", 0)) / n,
        "separators": share("[_+/-]"),
        "consonants": share("(?i)[b-df-hj-np-tv-xz]{4,}"),
        "userinfo": yes(F.concat("near", prefix).rlike(r"://([^\x20/:@]*:)?$") & (F.substr("word", F.length("prefix") + n + 1, F.lit(1)) == "@")),
        "block": yes(F.col("key_line")),
    }
    return found.select("*", *[F.coalesce(v, F.lit(0.0)).cast("double").alias(k) for k, v in columns.items()])


def labelled_findings(spark: SparkSession, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, text, secret): made-up findings, the same for each call; secrets are random and stand behind a name, in a
    URL or in a private key, the others are numbers, checksums, identifiers, paths, certificates and placeholders."""
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    seed = F.col("id").cast("string")
    drawn = lambda of, salt: F.pmod(F.xxhash64(seed, F.lit(salt)), F.lit(of))

    def one_of(values: list, salt: str) -> Column:
        every = F.split(F.lit("\n".join(values)), "\n") if isinstance(values[0], str) else F.array(*values)
        return F.element_at(every, (drawn(len(values), salt) + 1).cast("int"))

    def names(salt: str, least: int, join: str, form=lambda w: w) -> Column:
        """``least`` or one more words, half of them of the dictionary and half made up of syllables."""
        pick = lambda of, k, more: F.element_at(F.split(F.lit(" ".join(of)), " "), (F.pmod(F.xxhash64(seed, F.lit(salt + more), k), F.lit(len(of))) + 1).cast("int"))
        made = lambda k: F.when(F.pmod(F.xxhash64(seed, F.lit(salt), k), F.lit(2)) == 0, pick(DICTIONARY, k, "w")).otherwise(F.concat(pick(SYLLABLES, k, "x"), pick(SYLLABLES, k, "y")))
        return F.array_join(F.transform(F.sequence(F.lit(1), drawn(2, salt) + least), lambda k: form(made(k))), join)

    hexes = F.sha2(seed, 256)
    base = F.regexp_replace(F.base64(F.unhex(F.sha2(seed, 512))), r"[=\s]", "")
    letters = F.translate(hexes, "0123456789", "ghijkmnpqr")
    mixed = F.translate(base, "0123456789+/", "qWzXvKjYpHbN")
    # Written, as all of them in each text's place are too long to be compiled.
    pieces = {
        "hexes": hexes,
        "base": base,
        "digits": F.lpad(F.abs(F.xxhash64(seed)).cast("string"), 19, "7"),
        "number": drawn(900, "n").cast("string"),
        "name": one_of(["token", "secret", "api_key", "password", "access_token", "auth", "SECRET_KEY", "TOKEN", "client_secret", "apikey", "DB_PASSWORD", "private_key"], "k"),
        "sign": one_of([' = "', "=", ": ", ' = "', ': "', " = '"], "s"),
        "key": one_of([
            F.substring(hexes, 1, 40), F.substring(hexes, 1, 32), hexes, F.substr(base, F.lit(1), (drawn(50, "kl") + 20).cast("int")), F.substring(base, 1, 24),
            F.concat(F.lit("AKIA"), F.upper(F.substring(hexes, 1, 16))), F.concat(F.lit("sk_live_"), F.substring(base, 1, 24)),
            F.upper(F.substring(hexes, 1, 40)), F.substring(mixed, 1, 32), F.substring(mixed, 1, 24),
        ], "f"),
        "mixed": one_of([F.substring(mixed, 1, 24), F.substring(mixed, 1, 32), F.substring(mixed, 1, 48)], "m"),
        "short": one_of([
            F.substring(letters, 1, 8), F.substring(letters, 1, 12), F.substring(letters, 1, 20), F.substring(base, 1, 8),
            F.substring(base, 1, 12), F.concat(F.substring(base, 1, 5), F.lit("!"), F.substring(letters, 1, 3)),
            F.concat(one_of(DICTIONARY, "pw"), drawn(900, "pn").cast("string"), F.substring(letters, 1, 3)),
        ], "f"),
        "filler": one_of("required string null none true false optional the a changeme example value your_password text hidden int".split(), "f"),
        "user": one_of(["root", "admin", "user", "app", "bob", "deploy", "svc-build", ""], "u"),
        "scheme": one_of(["https", "postgres", "mysql", "redis", "mongodb", "amqp", "ftp"], "c"),
        "host": F.concat(one_of(["db", "cache", "build", "mirror", "data", "files", "queue", "shop"], "h"), one_of([".example.com", ".internal:5432", ".net", ":6379", ""], "t")),
        "kind": one_of(["RSA ", "EC ", "OPENSSH ", ""], "p"),
        "lead": names("l", 2, " "),
        "tail": names("r", 2, " "),
        "camel": F.concat(names("cc", 1, ""), names("cm", 3, "", F.initcap)),
        "dashed": names("d", 4, "-"),
        "snake": names("sn", 4, "_"),
        "path": names("pa", 4, "/"),
    }
    made_of = written(spark.range(rows).select(F.col("id").alias("doc_id"), *[v.alias(k) for k, v in pieces.items()]), "pieces")
    c = {k: F.col(k) for k in pieces}
    hexes, base, digits, number, name, sign, key = (c[k] for k in ("hexes", "base", "digits", "number", "name", "sign", "key"))
    mixed, short, filler, user, scheme, host, kind = (c[k] for k in ("mixed", "short", "filler", "user", "scheme", "host", "kind"))
    lead, tail, camel, dashed, snake, path = (c[k] for k in ("lead", "tail", "camel", "dashed", "snake", "path"))
    part = lambda first, n: F.substring(hexes, first, n)
    uuid = F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))
    pem = lambda head, end: text(lead, "\n-----BEGIN ", kind, head, "-----\n", F.substring(base, 1, 64), "\n", F.reverse(F.substring(base, 1, 64)), "\n", F.lower(F.substring(base, 1, 40)), F.substring(mixed, 1, 24), "\n", F.substring(mixed, 1, 40), F.substring(base, 1, 24), "\n", F.substring(mixed, 1, 14), end, "\n-----END ", kind, head, "-----\n", tail)
    secrets = [
        text(lead, " ", name, sign, key, '" ', tail),
        text("export ", name, "=", key, "\n", tail),
        text(lead, " Authorization: Bearer ", key, " ", tail),
        text("curl -H 'Authorization: token ", key, "' https://", host, "/", path),
        text("| ", lead, " | ", name, sign, key, '" | ', tail),
        text(lead, " ", name, sign, mixed, '" ', tail),
        text(lead, " ", name, sign, short, '" ', tail),
        text(name, ": ", short, "\nport: ", number, " ", tail),
        text('{"', name, '":"', key, '","', snake, '":"b"}'),
        text("https://", host, "/", path, "?id=", number, "&", name, "=", key),
        text(lead, " ", scheme, "://", user, ":", short, "@", host, "/db ", tail),
        text("DATABASE_URL=", scheme, "://", user, ":", key, "@", host, " ", tail),
        text("git clone https://", key, "@", host, "/", path, ".git"),
        pem("PRIVATE KEY", "=="),
        text(lead, " ", mixed, " ", tail),
    ]
    others = [
        text("commit ", part(1, 40), " ", tail),
        text("the sha256 checksum is ", hexes, " for the file"),
        text("sha256:", hexes, " ", tail),
        text("order number ", F.substring(digits, 1, 16), " ", tail),
        text(lead, " ", F.substring(digits, 1, 16), " ", tail),
        text(lead, ". ", F.substring(digits, 1, 18), ", ", tail),
        text("uuid = ", uuid, " ", tail),
        text(lead, " ", uuid, " ", tail),
        text("see /usr/lib/python", number, "/site-packages/module_", number, " there"),
        text("at https://example.com/", part(1, 6), "/data/list_of_items_", number, " there"),
        text("https://", host, "/", path, "/", dashed, " ", tail),
        text(lead, " ", name, sign, "your_api_key_here_", number, '" ', tail),
        text(lead, " ", name, sign, "xxxxxxxxxxxxxxxx", number, '" ', tail),
        text(lead, " ", name, sign, "example_password_", number, '" ', tail),
        text("call get_user_from_table_", number, "_by_name in"),
        text("https://", host, "/20", F.substring(digits, 1, 2), "/", number, "/", dashed, "-", number, ".htm ", tail),
        text(lead, " ", camel, "(", camel, ") ", tail),
        text(lead, " ", snake, " = ", dashed, " ", tail),
        text("open ", path, "/", snake, ".txt ", tail),
        text("./", path, "/", camel, ".java:", number, " ", tail),
        text("the ", part(1, 40), " etag of that"),
        text("etag: ", part(1, 32), " ", tail),
        text(lead, " ", name, sign, filler, '" ', tail),
        text(name, "=", filler, "\n", tail),
        text('{"id":"', part(1, 20), '","order":"', part(21, 20), '"}'),
        text(lead, " ", scheme, "://user:password@", host, "/db ", tail),
        text(lead, " ", scheme, "://", user, ":", filler, "@", host, " ", tail),
        text("https://", host, ":8080/", path, " contact ", user, "@example.com"),
        pem("CERTIFICATE", "=="),
        pem("PUBLIC KEY", "=="),
        text("docker pull ", F.substring(snake, 1, 12), ":", number, "-build-2024-01-", part(1, 4), "-", dashed),
        text("data:image/png;base64,", base, "== ", tail),
    ]
    all_of = [*[(x, True) for x in secrets for _ in range(2)], *[(x, False) for x in others]]
    row = F.pmod(F.col("doc_id"), F.lit(len(all_of)))
    made, label = F.lit(None).cast("string"), F.lit(False)
    for i, (x, secret) in enumerate(all_of):
        made = F.when(row == i, x).otherwise(made)
        label = F.when(row == i, F.lit(secret)).otherwise(label)
    return written(made_of.select("doc_id", made.alias("text"), label.alias("secret")), "findings")


def train(labelled: DataFrame, *, trees: int = 30, depth: int = 8, rows: int = TRAINING_ROWS) -> RandomForestClassificationModel:
    """A forest from (text, secret) rows; it learns from ``rows`` findings at most, chosen by hash.

    Rows with a null text or label, or without a candidate, teach nothing.
    """
    # Written, as a plan of made-up texts and of the patterns together is too long to be compiled.
    labelled = written(labelled.select("doc_id", "text", "secret"), "labelled")
    found = features(candidates(labelled, keep=("secret",))).filter(F.col("secret").isNotNull())
    bounded = found.orderBy(F.xxhash64("text_key", "place", "nth")).limit(rows).withColumn("label", F.col("secret").cast("double"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(bounded).select("vector", "label")
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="0.5", seed=1)
    return forest.fit(vectors)


def scan(documents: DataFrame, model: RandomForestClassificationModel, **options) -> DataFrame:
    """Per candidate: doc_id, text_key, place, nth, candidate, probability, secret.

    Null and empty texts have no candidates; so has an empty table.  Repeated
    rows give a row each.  Null ids and other columns don't matter.
    """
    found = features(candidates(documents, **options))
    judged = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(found))
    probability = vector_to_array("probability")[1]
    return judged.select(
        "doc_id", "text_key", "place", "nth", "candidate", probability.alias("probability"), (probability > 0.5).alias("secret")
    )


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    model = train(labelled_findings(spark))
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), model)
    return found.select("doc_id", "place", "nth", F.sha2("candidate", 256).alias("candidate_sha256"), "probability", "secret")
