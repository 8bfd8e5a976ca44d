"""Secret scan: wide candidates, and a random forest that removes false positives.

Candidates are long tokens, the values of assignments to names that end in a
credential-like word (``db_password``, ``"password":``), and passwords in URLs. A value
that holds another such name and sign ends there, and the inner one counts.
A forest over the candidate's length, character transitions, dictionary coverage,
path and neighbouring words, trained from labelled findings, gives each one its
probability of being a secret.

The dictionary is counted over all documents: letter runs of three to twenty
letters that at least ``least_docs`` documents contain. Coverage is the share of a
candidate's letters that lie in such runs.

Labelled findings come as a table (id, start, is_secret), or by
:func:`known_findings`, from what the whole table says about a value at its other
places, which no feature holds: a value that stands without a credential name at
``common`` different places is public (a commit, a digest, an id, a word), and one that
another place gives a credential name is a secret. A place is a value with its
surroundings, so copies of a text are one place. Where the table says nothing, rules
speak (published token formats, assignments of random-looking values; plain words, plain
numbers, rulers of one character), but a rule that the table contradicts in more than
5 % of the places where it says something gives no labels. The rest is the forest's.

Everything runs as Spark SQL expressions and Spark ML. At most ``train_rows``
labelled findings are fitted.

Cases: null and empty texts have no candidates; a null path has depth 0; a null id is
kept; rows that repeat an id are scanned one by one (a label counts for each);
without both labels every candidate keeps the share of true labels as its
score; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palmyra.llm.spans import after, before, matches, values_after
from palmyra.operators.skew import spread_join
from palmyra.sources.writers import cut_lineage

TRAIN_ROWS = 20_000
LEAST_DOCS = 10
#: Places without a credential name that make a value public.
COMMON = 5
#: A rule is held against the table's evidence where that speaks of so many places, and
#: needs that agreement.
HELD_PLACES, AGREEMENT = 20, 0.95
SEED = 3
CONTEXT = 40

TOKEN = r"(?:(?<![A-Za-z0-9_+/=.-])|\G)[A-Za-z0-9_+/=.-]{16,}+"
NAMES = (r"(?:password|passwd|pwd|secret(?:[_-]?key)?|token|api[_-]?key|access[_-]?key|auth"
         r"|credential|bearer)")
# From a name to its value: a closing quote, the sign, an opening quote, any blanks.
NAMED = rf"(?i){NAMES}[\"']?\s*+(?::=|=>|[=:])\s*+[\"']?(?=[^\s\"',;]{{6}})(?![=>])"
ASSIGNED = r"[^\s\"',;]{6,}+"
# A user's name in a URL, before the password.
LOGIN = r"://[^\s:/@\"']*+:(?=[^\s/\"'<>]+@)"
PASSWORD = r"[^\s/\"'<>]+(?=@)"
# Published formats of tokens; fixed values.
FORMATS = (r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abprs]-[0-9A-Za-z-]{10,}"
           r"|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]+\.[0-9A-Za-z_.-]+)$")
CREDENTIAL_WORDS = rf"(?i)(?:(?<![A-Za-z])|(?-i:(?<=[a-z])(?=[A-Z]))){NAMES}(?![A-Za-z])"
DUMMY_WORDS = r"(?i)(?:example|sample|dummy|test|fake|placeholder|changeme|xxxx|your[_-])"
IDENTIFIER_WORDS = (r"(?i)(?<![a-z])(?:commit|revision|sha-?[0-9]*|md5|digest|checksum|hash|etag|uuid|guid"
                    r"|build|version|id)(?![a-z])")
FEATURES = ("length", "letters", "digits", "uppers", "signs", "distinct", "switches",
            "switch_share", "longest_letters", "longest_digits", "hex", "vowels", "coverage",
            "longest_word", "path_depth", "slashes", "dots", "assigned", "quoted",
            "credential_words", "identifier_words", "dummy_words", "context_words", "sentence_end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         path_col: str | None = None) -> DataFrame:
    """(row, id, path, start, end, value, assigned, before, after), one row a
    candidate; a token that is also an assigned value comes once."""
    text = F.col("text")
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), path.alias("path"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    assigned = values_after(text, NAMED, ASSIGNED, text.rlike(NAMED))
    login = values_after(text, LOGIN, PASSWORD, F.instr(text, "://") > 0)
    apart = F.filter(login, lambda s: ~F.exists(assigned, lambda x: (x["start"] < s["end"])
                                                & (s["start"] < x["end"])))
    named = F.when(F.instr(text, "://") > 0, F.concat(assigned, apart)).otherwise(assigned)
    found = rows.select("id", "path", "text", named.alias("named"),
                        matches(text, TOKEN).alias("long"))
    alone = F.filter("long", lambda s: ~F.exists("named", lambda x: (x["start"] < s["end"])
                                                  & (s["start"] < x["end"])))
    mark = lambda flag: lambda s: s.withField("assigned", F.lit(flag))
    both = F.concat(F.transform("named", mark(True)), F.transform(alone, mark(False)))
    around = F.transform(both, lambda s: s.withField("before", before(text, s, CONTEXT))
                         .withField("after", after(text, s, CONTEXT)))
    spans = cut_lineage(found.select(F.monotonically_increasing_id().alias("row"), "id", "path",
                                     around.alias("spans")).where(F.size("spans") > 0),
                        "secret-spans")
    return spans.select("row", "id", "path", F.explode("spans").alias("s")).select(
        "row", "id", "path", "s.*")


def words_of(value: Column) -> Column:
    return F.regexp_extract_all(F.lower(value), F.lit("[a-z]{3,20}"), F.lit(0))


def dictionary(docs: DataFrame, text_col: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """Words that at least so many documents contain, over all documents."""
    each = F.explode(F.array_distinct(F.filter(
        F.split(F.lower(F.col(text_col)), "[^a-z]+"),
        lambda w: F.length(w).between(3, 20)))).alias("word")
    return (docs.select(each).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_docs).select("word"))


def coverage(spans: DataFrame, words: DataFrame) -> DataFrame:
    """Add known letters and the longest known word of each candidate. Pieces of
    candidates are looked up, each once, in the dictionary by a join."""
    pieces = (spans.select(F.explode(F.array_distinct(words_of(F.col("value")))).alias("word"))
              .distinct().join(words, "word"))
    known = (spans.select("row", "start", F.explode(words_of(F.col("value"))).alias("word"))
             .join(pieces, "word").groupBy("row", "start")
             .agg(F.sum(F.length("word")).alias("known"), F.max(F.length("word")).alias("longest")))
    return (spans.join(known, ["row", "start"], "left")
            .withColumn("known", F.coalesce("known", F.lit(0)))
            .withColumn("longest", F.coalesce("longest", F.lit(0))))


def features(spans: DataFrame) -> DataFrame:
    """The candidates with their features (f_...)."""
    v, b, a, path = F.col("value"), F.col("before"), F.col("after"), F.coalesce("path", F.lit(""))
    count = lambda c, p: F.length(c) - F.length(F.regexp_replace(c, p, ""))
    runs = lambda p: F.array_max(F.transform(F.split(v, p), F.length))
    # Class of each character; a transition is two neighbours of different classes.
    classes = F.translate(v, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
                          "a" * 26 + "A" * 26 + "0" * 10)
    switches = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1
    both = F.concat(b, F.lit(" "), a)
    f = {
        "length": F.length(v), "letters": count(v, "[A-Za-z]") / F.length(v),
        "digits": count(v, "[0-9]") / F.length(v), "uppers": count(v, "[A-Z]") / F.length(v),
        "signs": count(v, "[^0-9A-Za-z]") / F.length(v),
        "distinct": F.size(F.array_distinct(F.split(v, ""))), "switches": switches,
        "switch_share": switches / F.length(v), "longest_letters": runs("[^A-Za-z]+"),
        "longest_digits": runs("[^0-9]+"), "hex": v.rlike("^(?i)[0-9a-f]+$").cast("int"),
        "vowels": count(F.lower(v), "[aeiou]") / F.greatest(count(v, "[A-Za-z]"), F.lit(1)),
        "coverage": F.col("known") / F.greatest(count(v, "[A-Za-z]"), F.lit(1)),
        "longest_word": F.col("longest"), "path_depth": count(path, "/"), "slashes": count(v, "/"),
        "dots": count(v, r"\."), "assigned": F.col("assigned").cast("int"),
        "quoted": b.rlike("[\"']$").cast("int"), "credential_words": b.rlike(CREDENTIAL_WORDS).cast("int"),
        "identifier_words": b.rlike(IDENTIFIER_WORDS).cast("int"),
        "dummy_words": F.concat(both, v).rlike(DUMMY_WORDS).cast("int"),
        "context_words": F.size(words_of(both)), "sentence_end": a.rlike(r"^[\s.,;!?]").cast("int"),
    }
    return spans.select("row", "id", "path", "start", "end", "value", "assigned", "before", "after",
                        *(x.cast("double").alias(f"f_{k}") for k, x in f.items()))


def sure(rows: DataFrame) -> DataFrame:
    """The candidates with ``rule``: format or assigned (secrets), plain (none), or null."""
    v = F.col("value")
    random = (F.col("f_length") >= 20) & (F.col("f_digits") > 0.05) & (F.col("f_letters") > 0.05) \
        & (F.col("f_distinct") >= 8) & (F.col("f_dummy_words") == 0)
    plain = ~F.col("assigned") & (v.rlike(r"^[A-Za-z.-]+$") | v.rlike(r"^[0-9.-]+$")
                                  | v.rlike(r"^/?(?:[A-Za-z0-9_.-]+/){2,}[A-Za-z0-9_.-]*$")
                                  | (F.col("f_distinct") <= 3) | (F.col("f_dummy_words") == 1))
    return rows.withColumn("rule", F.when(v.rlike(FORMATS), "format")
                           .when(F.col("assigned") & random, "assigned").when(plain, "plain"))


def known_findings(table: DataFrame, common: int = COMMON) -> DataFrame:
    """(row, start, is_secret), at most one a place. Of a public value, whose places may
    be many, one with a credential name and one without count."""
    places = cut_lineage(
        sure(table).groupBy(F.md5("value").alias("v"), F.xxhash64("before", "after", "assigned").alias("place"))
        .agg(F.min(F.struct("row", "start")).alias("at"), F.max("assigned").alias("named"),
             F.max("rule").alias("rule"), F.max(F.col("value").rlike(DUMMY_WORDS)).alias("dummy")),
        "secret-places")
    values = places.groupBy("v").agg(
        F.count_if("named").alias("names"), F.count_if(~F.col("named")).alias("bare"), F.count("*").alias("_rows"),
        F.min(F.when(F.col("named"), F.col("at"))).alias("first_named"),
        F.min(F.when(~F.col("named"), F.col("at"))).alias("first_bare"))
    values = cut_lineage(values.where("_rows > 1"), "secret-values")
    # A value with one place has no other that could speak for it.
    told = spread_join(places, values.drop("_rows"), ["v"], counts=values.select("v", "_rows"))
    public = F.col("bare") >= common
    first = F.col("at").eqNullSafe(F.when(F.col("named"), F.col("first_named")).otherwise(F.col("first_bare")))
    secret = ((F.col("names") - F.col("named").cast("int") > 0) & (F.col("names") < common) & ~F.col("dummy"))
    told = cut_lineage(told.select(
        "at", "rule", (public & ~first).alias("again"), F.when(public, 0).when(secret, 1).alias("evidence"),
        (F.col("rule") != "plain").cast("int").alias("ruled")).where("not coalesce(again, false)"), "secret-told")
    right = {r.rule: (r.n, r.agreed) for r in told.where("evidence IS NOT NULL AND rule IS NOT NULL").groupBy("rule")
             .agg(F.count("*").alias("n"), F.count_if(F.col("evidence") == F.col("ruled")).alias("agreed")).collect()}
    trusted = [k for k in ("format", "assigned", "plain")
               if (n := right.get(k, (0, 0)))[0] < HELD_PLACES or n[1] >= AGREEMENT * n[0]]
    label = F.coalesce("evidence", F.when(F.col("rule").isin(trusted), F.col("ruled")))
    return (told.withColumn("is_secret", label).where(F.col("is_secret").isNotNull())
            .select("at.row", "at.start", "is_secret"))


def find(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text", path_col: str | None = None, train_rows: int = TRAIN_ROWS,
         least_docs: int = LEAST_DOCS, common: int = COMMON) -> DataFrame:
    """One row per candidate: id, start, end (code points, exclusive), value,
    assigned, score, is_secret (score >= 0.5). ``findings``: (id, start, is_secret)."""
    spans = scan(docs, id_col, text_col, path_col)
    table = cut_lineage(features(coverage(spans, dictionary(docs, text_col, least_docs))),
                        "secret-candidates")
    if findings is None:
        labels = known_findings(table, common)
    else:
        named = findings.select(F.col(id_col).alias("id"), "start",
                                F.col("is_secret").cast("int").alias("is_secret"))
        labels = table.select("row", "id", "start").join(named, ["id", "start"]) \
            .select("row", "start", "is_secret")
    # As many of either label at most: plain words outnumber secrets by far.
    order = F.xxhash64("row", "start")
    half = [labels.where(F.col("is_secret") == k).orderBy(order, "row", "start")
            .limit(train_rows // 2) for k in (0, 1)]
    chosen = cut_lineage(half[0].unionByName(half[1]), "secret-labels")
    n = {r.is_secret: r.n for r in chosen.groupBy("is_secret").agg(F.count("*").alias("n")).collect()}
    out = [F.col("id").alias(id_col), "start", "end", "value", "assigned"]
    if len(n) < 2:
        share = float(bool(n.get(1)))
        return table.select(*out, F.lit(share).alias("score"), F.lit(share >= 0.5).alias("is_secret"))
    rows = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="_v").transform(table)
    sample = rows.join(F.broadcast(chosen), ["row", "start"])   # at most train_rows rows
    forest = RandomForestClassifier(featuresCol="_v", labelCol="is_secret", numTrees=24, maxDepth=6,
                                    seed=SEED).fit(sample.select("_v", "is_secret").coalesce(2))
    score = vector_to_array("probability")[1]
    return (forest.transform(rows).withColumn("score", score)
            .select(*out, "score", (F.col("score") >= 0.5).alias("is_secret")))
