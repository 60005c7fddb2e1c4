"""Personal data: fixed forms, and identifiers that bootstrapped contexts discover.

E-mail addresses, IP addresses, card and phone numbers of fixed forms are the seeds. The words before and behind them
are lexical patterns. Patterns and identifier-like tokens form a graph, an edge for each occurrence of a token in a
pattern. Scores run over it in rounds: a pattern's score is the score of the tokens in it over all occurrences of its
word in the corpus, so a common word scores low however many seeds stand beside it; a token's score is the chance
that one of its patterns is right. Seeds have score 1 throughout. Tokens that end above the threshold are new
identifiers, wherever they stand.

Graph, counts and scores are tables; texts stay where they are. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger.llm.rows import documents, keeping, stored, text_of
from geoledger.llm.spans import MARK, count_of, found, let, listed, marked, none, overlaps

KINDS = ("email", "ip", "card", "phone", "ident")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
IP_PARTS = r"^0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])?(?:\.0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])?){3}$"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: A word with a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: A word with a digit and no at sign, and as many of them as follow each other behind single spaces, or a token.
PIECE = r"[^\x20\x09-\x0D0-9@]*+[0-9][^\x20\x09-\x0D@]*+(?!@)"
GROUP = rf"(?<![^\x20\x09-\x0D])(?:{PIECE}(?:(?<![.,;:!?\"'])\x20{PIECE})*+|{TOKEN})"
#: What stands before an identifier's first letter or digit; an opening bracket that closes inside belongs to it.
LEAD = r"^(?:[^A-Za-z0-9(]*+(?=\([^()]*+\)[^A-Za-z0-9]*+[A-Za-z0-9])|[^A-Za-z0-9]*+)"
SPACE = r"[\x20\x09-\x0D]+"
MARKS = ".,;:!?\"'()[]{}<>"
#: Characters around a token in which its neighbouring words are looked for.
AROUND = 64
#: Digits of a token that may be an identifier, unless it has an at sign.
LEAST_DIGITS = 5
#: Seeds a pattern must have seen, rounds of scoring, and the score of a new identifier.
LEAST_SEEDS, ROUNDS, LEAST_SCORE = 3, 3, 0.7
#: Added to the count of a pattern's word, so that few occurrences prove little.
SMOOTH = 1
#: Pattern words up to which they are broadcast to the words of the corpus: some 32 MB.
BROADCAST_WORDS = 500_000


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def added(back: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            d = F.substring(back, i, F.lit(1)).cast("int")
            twice = d * 2
            return a + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

        return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), step) % 10 == 0

    return let(F.reverse(digits), added)


def valid_card(s: Column) -> Column:
    return let(
        digits_of(s["hit"]), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False))
    )


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms, each kind from left to right."""
    numbers = text.rlike("[0-9]")
    return F.concat(
        F.when(F.contains(text, F.lit("@")), marked(found(text, EMAIL), 0)).otherwise(none(MARK)),
        F.when(numbers & F.contains(text, F.lit(".")), marked(found(text, IP), 1, lambda s: s["hit"].rlike(IP_PARTS))).otherwise(none(MARK)),
        F.when(numbers, marked(found(text, CARD), 2, valid_card)).otherwise(none(MARK)),
        F.when(
            numbers & F.contains(text, F.lit("+")),
            marked(found(text, PHONE), 3, lambda s: F.length(digits_of(s["hit"])).between(9, 15)),
        ).otherwise(none(MARK)),
    )


def plain(words: Column) -> Column:
    """Lower case without punctuation, as pattern words are counted."""
    return F.translate(F.lower(words), MARKS, "")


TOKENS = (
    "array<struct<start:bigint,end:bigint,form:string,left:string,right:string,seed:boolean,inner:boolean,outer:bigint>>"
)


def tokens(text: Column, base: Column) -> Column:
    """Identifier-like tokens with their place, form, neighbouring words and whether they are part of a seed.

    Words with digits behind single spaces are one token together, and each that is identifier-like alone is a token
    inside it. The words beside a token stand outside the whole group; they may hold digits."""

    def keep(hit: Column, place: Column) -> Column:
        return F.contains(hit, F.lit("@")) | (F.length(digits_of(hit)) >= LEAST_DIGITS) | overlaps(place, base)

    def described(hit: Column, place: Column, left: Column, right: Column, inner: bool, outer: Column) -> Column:
        lead = F.length(F.regexp_extract(hit, LEAD, 0))
        trail = F.length(F.regexp_extract(F.reverse(hit), "^[^A-Za-z0-9]*+", 0))
        return F.struct(
            (place["start"] + lead).alias("start"),
            (place["end"] - trail).alias("end"),
            F.lower(F.substring(hit, lead + 1, F.length(hit) - lead - trail)).alias("form"),
            left.alias("left"),
            right.alias("right"),
            overlaps(place, base).alias("seed"),
            F.lit(inner).alias("inner"),
            outer.alias("outer"),
        )

    def beside(gap: Column, word: Column, other: Column) -> Column:
        return F.when((word == "") & (F.length(gap) < AROUND), other).otherwise(word)

    def each(groups: Column) -> Column:
        def one(g: Column, i: Column) -> Column:
            before, after = F.split(plain(g["before"]), SPACE, -1), F.split(plain(g["after"]), SPACE, -1)
            last = F.element_at(F.split(plain(F.get(groups, i - 1)["hit"]), SPACE, -1), -1)
            first = F.get(F.split(plain(F.get(groups, i + 1)["hit"]), SPACE, -1), F.lit(0))
            left = beside(g["before"], F.get(before, F.size(before) - 2), last)
            right = beside(g["after"], F.get(after, F.lit(1)), first)

            def piece(s: Column) -> Column:
                place = F.struct((g["start"] + s["start"]).alias("start"), (g["start"] + s["end"]).alias("end"))
                own_left, own_right = F.when(s["start"] == 0, left), F.when(s["end"] == F.length(g["hit"]), right)
                return F.when(keep(s["hit"], place), described(s["hit"], place, own_left, own_right, True, g["start"]))

            pieces = F.filter(F.transform(found(g["hit"], TOKEN), piece), lambda t: t.isNotNull())
            whole = F.array(described(g["hit"], g, left, right, False, g["start"])).cast(TOKENS)
            both = F.concat(whole, F.when(F.contains(g["hit"], F.lit(" ")), pieces.cast(TOKENS)).otherwise(none(TOKENS)))
            return F.when(keep(g["hit"], g), both).otherwise(none(TOKENS))

        return F.flatten(F.transform(groups, one))

    return let(found(text, GROUP, AROUND), each)


def scanned(rows: DataFrame) -> DataFrame:
    """Rows with a column `text`, with base spans, tokens and a number of their own."""
    value = text_of("text")
    based = rows.withColumn("pii_base", base_spans(value))
    return based.withColumn(
        "_tokens",
        F.when(value.rlike("[0-9@]"), tokens(value, F.col("pii_base"))).otherwise(none(TOKENS)),
    ).withColumn("_row", F.monotonically_increasing_id())


def occurrences(scan: DataFrame) -> DataFrame:
    """(pattern, word, form, seed, inner) of each token beside a word."""
    each = scan.select(F.explode("_tokens").alias("t")).select("t.form", "t.left", "t.right", "t.seed", "t.inner")
    sides = F.array(F.struct(F.lit("L").alias("side"), F.col("left").alias("word")), F.struct(F.lit("R").alias("side"), F.col("right").alias("word")))
    return (
        each.select("form", "seed", "inner", F.explode(sides).alias("s"))
        .where(F.coalesce(F.col("s.word"), F.lit("")) != "")
        .select(F.concat_ws(":", "s.side", "s.word").alias("pattern"), F.col("s.word").alias("word"), "form", "seed", "inner")
    )


def word_counts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """How often each wanted word stands in all texts."""
    words = texts.select(F.explode(F.split(plain(text_of("text")), SPACE, -1)).alias("word"))
    return words.join(wanted, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("total"))


def discovered(scan: DataFrame, texts: DataFrame) -> DataFrame:
    """(form) of new identifiers."""
    # A word counts once for each group beside it, not for the pieces inside as well.
    graph = occurrences(scan).groupBy("pattern", "word", "form").agg(
        F.count_if(~F.col("inner")).alias("times"), F.max("seed").alias("seed")
    )
    able = (
        graph.where("seed AND times > 0").groupBy("pattern", "word").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= LEAST_SEEDS)
    )
    able = stored(able.select("pattern", "word"))
    wanted = able.select("word").distinct()
    totals = word_counts(texts, F.broadcast(wanted) if able.count() <= BROADCAST_WORDS else wanted)
    edges = stored(
        graph.join(able.select("pattern"), "pattern", "left_semi").join(totals, "word").select("pattern", "form", "times", "seed", "total")
    )
    seed_forms = edges.groupBy("form").agg(F.max("seed").cast("double").alias("score"))
    scores = seed_forms
    for _ in range(ROUNDS):
        patterns = (
            edges.join(scores, "form")
            .groupBy("pattern")
            .agg((F.sum(F.col("times") * F.col("score")) / (F.max("total") + SMOOTH)).alias("right"))
        )
        chance = F.least(F.col("right"), F.lit(0.999999))
        scores = stored(
            edges.join(patterns, "pattern")
            .groupBy("form")
            .agg(F.max("seed").alias("_seed"), (1 - F.exp(F.sum(F.log(1 - chance)))).alias("_any"))
            .select("form", F.when(F.col("_seed"), 1.0).otherwise(F.col("_any")).alias("score"))
        )
    fresh = edges.groupBy("form").agg(F.max("seed").alias("seed")).where(~F.col("seed"))
    return scores.where(F.col("score") >= LEAST_SCORE).join(fresh, "form", "left_semi").select("form")


def with_discovered(scan: DataFrame, texts: DataFrame) -> DataFrame:
    """All rows of a stored scan with `pii_spans`: base spans, and new identifiers outside them, of a group and its pieces
    the group."""
    mark = F.struct(F.col("t.start").alias("start"), F.lit(4).alias("kind"), F.col("t.end").alias("end"))
    fresh = (
        scan.select("_row", F.explode("_tokens").alias("t"))
        .where(~F.col("t.seed"))
        .select("_row", F.col("t.form").alias("form"), "t.outer", "t.inner", mark.alias("mark"))
        .join(discovered(scan, texts), "form", "left_semi")
        .groupBy("_row", "outer")
        .agg(
            F.collect_list(F.when(~F.col("inner"), F.col("mark"))).alias("whole"),
            F.collect_list(F.when(F.col("inner"), F.col("mark"))).alias("pieces"),
        )
        .groupBy("_row")
        .agg(F.flatten(F.collect_list(F.when(F.size("whole") > 0, F.col("whole")).otherwise(F.col("pieces")))).alias("_fresh"))
    )
    return (
        scan.join(fresh, "_row", "left")
        .withColumn("pii_spans", F.concat("pii_base", F.coalesce("_fresh", none(MARK))))
        .drop("_row", "_fresh", "_tokens")
    )


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """All rows with `pii_base` and `pii_spans`, arrays of (start, kind, end) in code points, kinds as in KINDS.

    Null and empty texts have no spans. Each row counts, also a repeated one; ties need no order. An empty table stays
    empty. Input columns of these names are replaced, others stay.
    """

    def body(rows: DataFrame) -> DataFrame:
        scan = stored(scanned(rows))
        return with_discovered(scan, scan.select("text"))

    return keeping(df, {"text": text}, body, ["pii_base", "pii_spans"])


def op4_bootstrapped_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    spotted = with_discovered(stored(scanned(docs).drop("text")), docs.select("text"))
    base = F.col("pii_base")
    return spotted.select(
        "doc_id",
        *[count_of(base, k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])],
        F.sha2(listed(base, KINDS), 256).alias("base_sha256"),
        listed(F.col("pii_spans"), KINDS).alias("spans"),
    )
