"""Personal data: candidate spans, boosted trees, calibrated thresholds.

High-recall generators propose spans of five families, which may overlap. A
candidate in the strict form of its family is checked by that family's rule
(numeric ranges, digit counts, Luhn); those that pass are the base spans, which
always stay. Strict candidates, passed or failed, are also the labelled examples
for gradient-boosted trees over format and context features, which also judge the
candidates that the strict forms miss (spelled-out addresses, numbers without a
country code, grouped account numbers).

No rule labels those, so the trees also learn from examples made of what the rules know.
True ones: base spans written in another form, where they are and elsewhere (a spelled-out
address, a number without its country code; account numbers from the digits of card
numbers). False ones: numbers with no person behind them (years, dates, versions, rows of
a table, product keys), in surroundings taken from elsewhere in the texts. False examples
of emails are only those that the texts hold, wide matches that are plainly ordinary text:
the domain does not end as a host name does ("growth at 3.5"), or a plain word, a bare
"at" and plain dots ("look at example.com"). Features hold part of what the rules go by (n_digits
is the phone rule's count; prose and host_tail are the email rules), but neither
the ranges of address parts nor Luhn sums.

Per family the threshold is the lowest score from which on the calibration examples
reach the target precision, both labels weighing the same however many of each there
are; a family that never does, or whose calibration examples lack a label, adds
nothing. Added spans that overlap a base span are dropped.

Everything runs as Spark SQL expressions and Spark ML. The trees are fitted on all
labelled candidates of two thirds of the rows, and the thresholds count all of the
other third's; each family and label weighs the same in all, so a mass of one kind of
number does not outweigh another family's examples. With ``train_rows`` (default: none)
at most so many are taken. Generators, rules and scores cover every text.

Cases: null and empty texts have no spans; a null id is kept; rows that repeat an id
are judged one by one; without both kinds of examples nothing is added; an empty
table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palmyra.llm.spans import after, before, digits, luhn, matches
from palmyra.sources.writers import cut_lineage

KINDS = ("email", "ip", "card", "phone", "id")
TARGET_PRECISION = 0.95
SEED = 5

# Strict forms. Possessive where the plain form would only backtrack in vain; the
# matches are those of the plain forms.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

# Wide forms.
AT = r"(?:\x20?(?:\(at\)|\[at\]|\{at\})\x20?|\x20at\x20)"
DOT = r"(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)"
WIDE_EMAIL = (rf"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++{AT}"
              rf"[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++")
# Ordinary text that the wide form takes: a word, a bare "at" and plain dots.
PROSE = r"^[A-Za-z]+ at [A-Za-z0-9.-]+$"
HOST_TAIL = r"[^A-Za-z0-9-](?:[A-Za-z]{2,}|xn--[A-Za-z0-9-]+)$"
WIDE_PHONE = r"(?<![0-9+.A-Za-z-])(?:00|\(|0)?[0-9]{2,4}[)]?(?:[\x20.-][(]?[0-9]{2,4}[)]?){2,5}(?![0-9])"
WIDE_ID = (r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}"
           r"|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?)(?!-?[0-9A-Za-z])")

CONTEXT = 40
CONTACT_WORDS = (r"(?i)\b(?:e-?mail|mail|contact|phone|tel|telephone|mobile|call|fax|card|visa|"
                 r"credit|iban|account|ssn|address|server|host|ip|reach|write|kontakt|anruf|correo|"
                 r"llamar|courriel|appel)\b")
FEATURES = ("length", "n_digits", "digit_share", "n_letters", "n_separators", "n_groups",
            "longest_group", "distinct_digits", "leading_zero", "parens", "before_space",
            "before_letter", "after_space", "after_letter", "contact_words", "context_digits",
            "context_capitals", "in_doc", "prose", "host_tail", "years", "letter_groups",
            "groups_of_two", *(f"is_{k}" for k in KINDS))


def _typed(spans: Column, kind: str, base, label) -> Column:
    return F.transform(spans, lambda s: F.struct(
        F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("place"), s["start"].alias("start"),
        s["end"].alias("end"), s["value"].alias("value"), base(s["value"]).alias("base"),
        label(s["value"]).cast("int").alias("label")))


def candidates(text: Column) -> Column:
    """All candidate spans of a text: kind, start, end, value, whether it is a base
    span, and the label that a rule gives it (1, 0, or null where none is sure)."""
    number = text.rlike("[0-9]")
    at, sign = F.instr(text, "@") > 0, F.instr(text, "+") > 0
    n = lambda v: F.length(digits(v))
    no = lambda v: F.lit(False)
    unknown = lambda v: F.lit(None)
    strict = lambda spans, kind, valid: _typed(spans, kind, valid, valid)
    return F.concat(
        strict(matches(text, EMAIL, at), "email", lambda v: F.lit(True)),
        strict(matches(text, IP, number), "ip", lambda v: v.rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
        strict(F.filter(matches(text, CARD, number), lambda s: n(s["value"]) >= 12), "card",
               lambda v: n(v).between(14, 19) & luhn(v)),
        strict(matches(text, PHONE, number & sign), "phone", lambda v: n(v).between(10, 15)),
        _typed(matches(text, WIDE_EMAIL, text.rlike(AT)), "email", no,
               lambda v: F.when(v.rlike(PROSE) | ~v.rlike(HOST_TAIL), 0)),
        _typed(matches(text, WIDE_PHONE, number), "phone", no, unknown),
        _typed(matches(text, WIDE_ID, number), "id", no, unknown))


def _one_of(seed: Column, *options) -> Column:
    return F.element_at(F.array(*(o if isinstance(o, Column) else F.lit(o) for o in options)),
                        (F.pmod(seed, F.lit(len(options))) + 1).cast("int"))


def _written_otherwise(s: Column) -> Column:
    """A true value in a wide form: of a base email or phone number, or an account number
    from a card's digits; null for others."""
    v, d, h = s["value"], digits(s["value"]), F.xxhash64(s["value"], s["start"])
    part = lambda at, n: F.substring(d, at, n)
    at = _one_of(h, " (at) ", " [at] ", "(at)", " at ")
    dot = _one_of(F.shiftright(h, 8), " (dot) ", " dot ", "[dot]")
    mail = F.concat(F.substring_index(v, "@", 1), at, F.replace(F.substring_index(v, "@", -1), F.lit("."), dot))
    # Half of the names lose their digits: names of one corpus tend to look alike.
    mail = F.when(F.pmod(h, F.lit(2)) == 0, F.regexp_replace(mail, "(?<=[A-Za-z])[0-9]+", "")).otherwise(mail)
    tail = lambda at, n: F.substring(d, at - 11, n)  # the last ten digits from the left
    call = _one_of(h, F.concat(F.lit("0"), tail(1, 3), F.lit(" "), tail(4, 3), F.lit(" "), tail(7, 4)),
                   F.concat(F.lit("(0"), tail(2, 2), F.lit(") "), tail(4, 3), F.lit(" "), tail(7, 4)),
                   F.concat(F.lit("("), tail(1, 3), F.lit(") "), tail(4, 3), F.lit("-"), tail(7, 4)),
                   F.concat(F.lit("0"), tail(2, 2), F.lit("-"), tail(4, 3), F.lit("-"), tail(7, 4)),
                   F.concat(F.lit("00"), tail(1, 2), F.lit(" "), tail(3, 3), F.lit(" "), tail(6, 3), F.lit(" "), tail(9, 2)),
                   F.concat(F.lit("(0"), tail(2, 2), F.lit(") "), tail(4, 3), F.lit(" "), tail(7, 2), F.lit(" "), tail(9, 2)))
    gap = _one_of(F.shiftright(h, 8), " ", "")
    iban = F.concat(_one_of(F.shiftright(h, 4), "DE", "FR", "ES", "GB", "NL", "IT"), part(1, 2), gap, part(3, 4), gap,
                    part(7, 4), gap, part(11, 4), gap, part(2, 4), gap, part(6, 2))
    account = _one_of(h, F.concat(part(1, 3), F.lit("-"), part(4, 2), F.lit("-"), part(6, 4)), iban)
    kind = s["kind"]
    return F.when(kind == "email", mail).when(kind == "phone", call).when(kind == "card", account)


def _nobody(place: Column) -> Column:
    """A false value for each of two families at a place in a text, by its hash."""
    h = F.xxhash64(place["before"], place["after"])
    n = lambda i, lo, hi: (lo + F.pmod(F.xxhash64(h, F.lit(i)), F.lit(hi - lo))).cast("string")
    year = F.lit(1950) + F.pmod(h, F.lit(80))
    number = _one_of(F.shiftright(h, 6),
                     F.concat_ws(" ", year, year + 1, year + 2), F.concat_ws(" ", year, year + 10, year + 20, year + 30),
                     F.concat_ws(".", n(1, 10, 29), n(2, 10, 13), year), F.concat_ws("-", year, n(2, 10, 13), n(1, 10, 29)),
                     F.concat_ws(".", n(1, 10, 99), n(2, 10, 99), n(3, 10, 9999)),
                     F.concat_ws(" ", n(1, 10, 99), n(2, 10, 99), n(3, 10, 99), n(4, 10, 99)),
                     F.concat_ws(" ", n(1, 10, 999), n(2, 10, 9999), n(3, 10, 999)),
                     F.concat_ws(" ", n(1, 100, 9999), n(2, 100, 9999), n(3, 10, 9999), n(4, 10, 99), n(5, 100, 999)),
                     F.concat_ws("-", F.lit("978"), n(1, 10, 99), n(2, 1000, 9999), n(3, 1000, 9999)))
    letters = lambda i: F.upper(F.translate(F.substring(F.hex(F.xxhash64(h, F.lit(i))), 1, 4), "01234567", "GHJKLMNP"))
    product = F.concat_ws(" ", F.concat(F.substring(letters(1), 1, 2), n(1, 10, 99)), letters(2), letters(3), letters(4), letters(5))
    return F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("value"))
                     for k, v in (("phone", number), ("id", product))))


def made_examples(spans: DataFrame) -> DataFrame:
    """(row, spans) as :func:`scan` has them, of labelled examples that are not in the
    texts: base spans written otherwise, and numbers of nobody at other places."""
    def typed(kind, value, near, label, at):
        return F.struct(kind.alias("kind"), F.lit(0).alias("place"), (-1 - at).alias("start"), F.lit(-1).alias("end"),
                        value.alias("value"), F.lit(False).alias("base"), F.lit(label).alias("label"),
                        near["before"].alias("before"), near["after"].alias("after"))

    sound = F.filter("spans", lambda s: s["base"] & (s["kind"] != "ip"))
    def rewritten(near, shift):
        return F.transform(sound, lambda s: typed(
            F.when(s["kind"] == "card", "id").otherwise(s["kind"]), _written_otherwise(s),
            s if near is None else near, 1, s["start"] + shift))
    # In their own surroundings and, so that these don't decide, in others of the text.
    here = rewritten(None, 0)
    true = F.when(F.col("other").isNull(), here).otherwise(F.concat(here, rewritten(F.col("other"), 1)))
    false = F.transform(_nobody(F.col("other")), lambda x: typed(x["kind"], x["value"], F.col("other"), 0, F.lit(0)))
    return (spans.select("row", true.alias("spans")).where(F.size("spans") > 0)
            .unionByName(spans.where(F.col("other").isNotNull()).select("row", false.alias("spans"))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, spans, other) of every row; spans with their surroundings, and those of
    another place in the text (null where it is short). Written at once, which also fixes
    the row numbers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .select("id", text.alias("text"), candidates(text).alias("found")))
    around = F.transform("found", lambda s: s.withField("before", before(F.col("text"), s, CONTEXT))
                         .withField("after", after(F.col("text"), s, CONTEXT)))
    where = F.struct((CONTEXT + F.pmod(F.xxhash64("text"), F.char_length("text") - 2 * CONTEXT)).cast("int").alias("start"),
                     (CONTEXT + F.pmod(F.xxhash64("text"), F.char_length("text") - 2 * CONTEXT)).cast("int").alias("end"))
    other = F.when(F.char_length("text") > 2 * CONTEXT, F.struct(
        F.concat(before(F.col("text"), where, CONTEXT), F.lit(" ")).alias("before"),
        F.concat(F.lit(" "), after(F.col("text"), where, CONTEXT)).alias("after")))
    return cut_lineage(found.select(F.monotonically_increasing_id().alias("row"), "id",
                                    around.alias("spans"), other.alias("other")), "pii-spans")


def features(spans: DataFrame) -> DataFrame:
    """One row a candidate with its features (f_...). Those of an email's format are
    of its plain form, so a spelled-out address is judged like any other."""
    email = F.col("kind") == "email"
    plain = F.regexp_replace(F.regexp_replace("value", AT, "@"), DOT, ".")
    v, b, a = F.when(email, plain).otherwise(F.col("value")), F.col("before"), F.col("after")
    both = F.concat(b, F.lit(" "), a)
    seps = F.length(F.regexp_replace(v, r"[0-9A-Za-z]", ""))
    count = lambda c, p: F.size(F.regexp_extract_all(c, F.lit(p), F.lit(0)))
    f = {
        "length": F.length(v), "n_digits": F.length(digits(v)),
        "digit_share": F.length(digits(v)) / F.length(v),
        "n_letters": F.length(F.regexp_replace(v, "[^A-Za-z]", "")), "n_separators": seps,
        "n_groups": count(v, "[0-9A-Za-z]+"),
        "longest_group": F.array_max(F.transform(F.split(v, "[^0-9A-Za-z]+"), F.length)),
        "distinct_digits": F.size(F.array_distinct(F.split(digits(v), ""))),
        "leading_zero": v.rlike(r"^[+(]?0").cast("int"), "parens": (F.instr(v, "(") > 0).cast("int"),
        "before_space": (b.rlike(r"\s$") | (b == "")).cast("int"),
        "before_letter": b.rlike(r"\p{L}$").cast("int"),
        "after_space": (a.rlike(r"^[\s.,;:]") | (a == "")).cast("int"),
        "after_letter": a.rlike(r"^\p{L}").cast("int"), "contact_words": count(both, CONTACT_WORDS),
        "context_digits": F.length(digits(both)),
        "context_capitals": F.length(F.regexp_replace(both, "[^A-Z]", "")),
        "in_doc": F.log1p(F.col("in_doc")),
        "prose": (email & F.col("value").rlike(PROSE)).cast("int"),
        "years": count(v, r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])"),
        "letter_groups": count(v, "[A-Z]{2,}"), "groups_of_two": count(v, r"(?<![0-9])[0-9]{2}(?![0-9])"),
        "host_tail": (email & F.col("value").rlike(HOST_TAIL)).cast("int"), **{f"is_{k}": (F.col("kind") == k).cast("int") for k in KINDS},
    }
    rows = spans.select("row", F.size("spans").alias("in_doc"), F.explode("spans").alias("s")) \
        .select("row", "in_doc", "s.*")
    keep = ["row", "kind", "place", "start", "end", "base", "label"]
    return rows.select(*keep, *(x.cast("double").alias(f"f_{k}") for k, x in f.items()))


def sampled(table: DataFrame, train_rows: int) -> DataFrame:
    """Labelled rows: at most an eighth of ``train_rows`` of each family (the four with a
    strict form, and the made examples of ids) and label."""
    labelled, shares = [(k, label) for k in KINDS for label in (0, 1)], 8
    each = [table.where((F.col("kind") == k) & (F.col("label") == label))
            .orderBy(F.xxhash64("row", "start", "kind"), "row", "start")
            .limit(max(train_rows // shares, 1)) for k, label in labelled]
    return reduce(DataFrame.unionByName, each)


def select_added(table: DataFrame, train_rows: int | None = None,
                 precision: float = TARGET_PRECISION, made: DataFrame | None = None) -> DataFrame:
    """(row, kind, place, start, end, score) of the candidates beyond the base
    spans that their family's threshold selects. ``made``: further labelled examples."""
    rows = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="_v").transform(table)
    labelled = table if made is None else table.unionByName(made)
    known = sampled(labelled, train_rows) if train_rows else labelled.where(F.col("label").isNotNull())
    known = known.withColumn("part", F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(3)))
    if train_rows:
        known = cut_lineage(known, "pii-sample")
    known = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="_v").transform(known)
    fit = known.where("part > 0")
    none = table.where(F.lit(False)).select("row", "kind", "place", "start", "end",
                                            F.lit(0.0).alias("score"))
    n = {(r.kind, r.label): r.n for r in
         fit.groupBy("kind", "label").agg(F.count("*").alias("n")).collect()}
    if len({label for _, label in n}) < 2:
        return none
    # Each family and label weighs the same in all; 1 a row on average.
    weight = F.coalesce(*(F.when((F.col("kind") == k) & (F.col("label") == label),
                                 F.lit(sum(n.values()) / len(n) / m))
                          for (k, label), m in sorted(n.items())))
    trees = GBTClassifier(featuresCol="_v", labelCol="label", weightCol="weight", maxIter=15, maxDepth=4, stepSize=0.3,
                          seed=SEED, minInstancesPerNode=4).fit(
        fit.select("_v", "label", weight.alias("weight")))
    probability = vector_to_array("probability")[1]
    # Examples of equal score are counted together first, so only a family's different
    # scores (sums of leaves) meet in the windows, not its examples.
    held = cut_lineage(
        trees.transform(known.where("part = 0")).select("kind", "label", probability.alias("score"))
        .groupBy("kind", "score").agg(F.count_if(F.col("label") == 1).alias("n_true"),
                                      F.count_if(F.col("label") == 0).alias("n_false")), "pii-scores")
    # Shares of the true and of the false examples at or above a score; null, so
    # no threshold, where the family lacks either.
    every = Window.partitionBy("kind")
    upto = every.orderBy(F.desc("score"))
    share = lambda x: F.sum(x).over(upto) / F.nullif(F.sum(x).over(every), F.lit(0))
    right, wrong = share("n_true"), share("n_false")
    limits = (held.withColumn("p", right / (right + wrong)).where(F.col("p") >= precision)
              .groupBy("kind").agg(F.min("score").alias("least")))
    # Between that score and the next lower one no example lies: the middle is the limit.
    below = (held.join(limits, "kind").where(F.col("score") < F.col("least"))
             .groupBy("kind").agg(F.max("score").alias("next")))
    limits = limits.join(below, "kind", "left").select(
        "kind", ((F.col("least") + F.coalesce("next", "least")) / 2).alias("least"))
    found = {r.kind: r.least for r in limits.collect()}     # at most one row a family
    # Calibration examples may all be told apart; a limit below one half would then mean little.
    least = F.coalesce(*(F.when(F.col("kind") == k, F.lit(max(float(found.get(k, 2.0)), 0.5)))
                         for k in KINDS))
    return (trees.transform(rows.where(~F.col("base")))
            .select("row", "kind", "place", "start", "end", probability.alias("score"))
            .where(F.col("score") >= least))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind in the order of KINDS."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"], s["place"], s["end"], s["kind"])))
    return F.concat_ws(",", F.transform(order, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         train_rows: int | None = None, precision: float = TARGET_PRECISION) -> DataFrame:
    """Per row: id, base and added spans (kind, place, start, end, ...)."""
    spans = scan(docs, id_col, text_col)
    table = cut_lineage(features(spans.where(F.size("spans") > 0)), "pii-candidates")
    made = cut_lineage(features(made_examples(spans)), "pii-examples")
    added = (select_added(table, train_rows, precision, made).groupBy("row")
             .agg(F.collect_list(F.struct("kind", "place", "start", "end")).alias("added")))
    base = F.transform(F.filter("spans", lambda s: s["base"]),
                       lambda s: F.struct(s["kind"], s["place"], s["start"], s["end"]))
    none = F.array().cast("array<struct<kind:string,place:int,start:int,end:int>>")
    out = (spans.select("row", "id", base.cast(none_type()).alias("base"))
           .join(added, "row", "left")
           .withColumn("added", F.coalesce("added", none)))
    free = F.filter("added", lambda x: ~F.exists("base", lambda s: (s["start"] < x["end"])
                                                  & (x["start"] < s["end"])))
    return out.select(F.col("id").alias(id_col), "base", F.array_distinct(free).alias("added"))


def none_type() -> str:
    return "array<struct<kind:string,place:int,start:int,end:int>>"


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
           ) -> DataFrame:
    """Texts with every span replaced by its kind in brackets; of overlapping spans
    the first by start counts. Ids must be unique."""
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"], s["end"], s["kind"])))
    text = F.coalesce(F.col(text_col), F.lit(""))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"), F.concat(acc["out"], gap, label).alias("out")))

    done = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    rest = F.substring(text, F.col("_done.at") + 1, F.char_length(text))
    return (docs.join(found.select(id_col, spans.alias("_spans")), id_col, "left")
            .withColumn("_spans", F.coalesce("_spans", F.array().cast(
                "array<struct<start:int,end:int,kind:string>>")))
            .withColumn("_done", done)
            .withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.concat("_done.out", rest)))
            .drop("_spans", "_done"))


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base spans per kind, their digest and the list of all spans."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(id_col, *(count(k).alias(f"n_{k}") for k in KINDS[:4]),
                        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.concat("base", "added")).alias("spans"))
