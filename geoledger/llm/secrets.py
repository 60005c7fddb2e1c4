"""Secrets: fixed forms, and tokens that randomness tests cannot tell from random ones.

A candidate is a run of key characters: of 12 or more with a letter and a digit, or of 20 or more with a letter. Its
encoding is the smallest alphabet that holds it, which turns it into numbers. Three tests look for structure:
chi-squared of how evenly the alphabet is used, runs above and below its middle, and correlation of neighbours. Fisher's
method joins their p-values.

What structure looks like is learnt from the corpus. The candidates in which the battery finds structure tell how often
a kind of character (vowel, consonant, either case, digit, sign) follows another one, by encoding. Against a random
token of the encoding, whose transitions are known, they give each candidate a score that is standard normal if it is
random and large if it is a name, a path or a phrase.

The tokens reported are those with a low score and without structure. Here structured tokens are the false discoveries:
by encoding and length class the cut is the highest at which no more than 5 % of what is reported is expected to be
structured. That is judged by the spread of structured tokens for their length, and by what is there beyond the random
tokens that the lower half of the scores implies. Short tokens have scores that overlap more, and get a lower cut.

Counts by encoding, length class and score are all that leaves the executors. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger.llm.rows import documents, keeping, stored, text_of
from geoledger.llm.spans import MARK, count_of, found, let, listed, marked, masked, none, overlaps

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?:\G|(?<![0-9a-f]))[0-9a-f]{24,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}+"
#: Length from which a candidate need not hold a digit.
LONG = 20
#: Candidates in a form of identifiers that hold no secret: UUIDs, dates and times.
IDENTIFIER = (
    r"^(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T_-][0-9]{2,6}(?:-[0-9]{2})*Z?)?)$"
)
#: Encoding: the form of a token and its alphabet. The first that fits is the inferred one.
ENCODINGS = (
    (r"^[0-9a-f]+$", "0123456789abcdef"),
    (r"^[0-9A-F]+$", "0123456789ABCDEF"),
    (r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (r"^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    (r"^.+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
#: Share of structured tokens among those reported that is allowed.
FALSE_SHARE = 0.05
#: Steps of a unit of -ln(p), and the most steps told apart.
STEPS, MOST_STEPS = 20, 2000
#: p-values of the battery below which a token teaches what structure looks like, and below which it is not reported.
TAUGHT_P, ORDERLY_P = 0.01, 0.001
#: Kinds of characters; a sign is any other.
KINDS_OF = {"v": "aeiou", "c": "bcdfghjklmnpqrstvwxyz", "V": "AEIOU", "C": "BCDFGHJKLMNPQRSTVWXYZ", "d": "0123456789"}
SIGN = "s"
#: Steps of a unit of the score, its bounds, the highest cut, and the score from which a token is surely structured.
SCORE_STEPS, LOWEST, HIGHEST, HIGHEST_CUT, SURE = 10, -80, 300, 25, 3.0
#: Length classes of a doubling.
SIZES = 2
#: Candidates of a class below the middle score from which their number tells how many are random.
ENOUGH = 30


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, to about 1e-7."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + x * 0.3275911)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * F.exp(-x * x) / 2
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-300))


def letters_of(token: Column) -> Column:
    """The characters of a token, two at least."""
    letters = F.filter(F.split(token, "", -1), lambda c: c != "")
    return F.concat(letters, F.array_repeat(F.lit("="), F.greatest(2 - F.length(token), F.lit(0))))


def structure_p(token: Column, alphabet: Column) -> Column:
    """The joint p-value of the battery: small if a token of this alphabet has structure."""
    size = F.length(alphabet)
    bare = F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/")
    # '=' within a token is no digit of any encoding; it counts as the first one.
    numbers = F.transform(letters_of(bare), lambda c: F.greatest(F.instr(alphabet, c) - 1, F.lit(0)))

    def battery(v: Column) -> Column:
        n = F.size(v).cast("double")
        places = F.sequence(F.lit(1), F.size(v) - 1)
        squares = F.aggregate(
            F.transform(F.sequence(F.lit(0), size - 1), lambda d: F.size(F.filter(v, lambda x: x == d))),
            F.lit(0.0),
            lambda a, c: a + c.cast("double") * c,
        )
        free = size - 1
        chi = F.greatest(squares * size / n - n, F.lit(1e-9))
        even = (F.pow(chi / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        turns = F.size(F.filter(places, lambda i: (F.get(v, i) * 2 >= size) != (F.get(v, i - 1) * 2 >= size)))
        runs = (turns - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        middle, spread = (size - 1) / 2, (size * size - 1) / 12
        serial = F.aggregate(
            places, F.lit(0.0), lambda a, i: a + (F.get(v, i) - middle) * (F.get(v, i - 1) - middle) / spread
        ) / F.sqrt(n - 1)
        logs = -2 * (
            F.log(upper_tail(even))
            + F.log(F.least(F.lit(1.0), 2 * upper_tail(F.abs(runs))))
            + F.log(F.least(F.lit(1.0), 2 * upper_tail(F.abs(serial))))
        )
        half = logs / 2
        return F.exp(-half) * (1 + half + half * half / 2)  # chi-squared with six degrees of freedom

    return let(numbers, battery)


def kinds_of(token: Column) -> Column:
    """The token with each character replaced by its kind."""
    signs = "+/_=-"
    source = "".join(KINDS_OF.values()) + signs
    return F.translate(token, source, "".join(k * len(v) for k, v in KINDS_OF.items()) + SIGN * len(signs))


def candidates(text: Column, base: Column) -> Column:
    """(start, end, encoding, length class, step of the p-value, kinds of characters) of tokens outside the base spans."""

    def judged(s: Column) -> Column:
        token = s["hit"]
        code = F.lit(len(ENCODINGS) - 1)
        for k in range(len(ENCODINGS) - 2, -1, -1):
            code = F.when(token.rlike(ENCODINGS[k][0]), k).otherwise(code)
        p = let(F.get(F.array(*[F.lit(a) for _, a in ENCODINGS]), code), lambda a: structure_p(token, a))
        step = F.least(F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * STEPS), F.lit(MOST_STEPS)).cast("int")
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            code.alias("encoding"),
            F.floor(F.log2(F.length(token).cast("double")) * SIZES).cast("int").alias("size"),
            F.greatest(step, F.lit(0)).alias("step"),
            kinds_of(token).alias("kinds"),
        )

    def tested(s: Column) -> Column:
        token = s["hit"]
        mixed = token.rlike("[A-Za-z]") & (token.rlike("[0-9]") | (F.length(token) >= LONG))
        return mixed & ~token.rlike(IDENTIFIER) & ~overlaps(s, base)

    return F.transform(F.filter(found(text, CANDIDATE), tested), judged)


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms, each kind from left to right."""
    assign = F.filter(
        found(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= 6
    )
    return F.concat(
        F.when(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), marked(assign, 0)).otherwise(none(MARK)),
        F.when(
            F.contains(text, F.lit("AKIA")), marked(found(text, ACCESS), 1, lambda s: s["end"] - s["start"] >= 20)
        ).otherwise(none(MARK)),
        F.when(text.rlike("[0-9a-f]{24}"), marked(found(text, HEX), 2)).otherwise(none(MARK)),
    )


def scanned(rows: DataFrame) -> DataFrame:
    """Rows with a column `text`, with their base spans and candidates."""
    value = text_of("text")
    based = rows.withColumn("secret_base", base_spans(value))
    kind = "array<struct<start:bigint,end:bigint,encoding:int,size:int,step:int,kinds:string>>"
    tokens = F.when(value.rlike(CANDIDATE), candidates(value, F.col("secret_base"))).otherwise(none(kind))
    return based.withColumn("secret_candidates", tokens)


def random_shares(encoding: int) -> dict[str, float]:
    """How often a kind of character occurs in random tokens of an encoding."""
    alphabet = ENCODINGS[encoding][1]
    shares = {k: sum(c in v for c in alphabet) / len(alphabet) for k, v in KINDS_OF.items()}
    return shares | {SIGN: max(1 - sum(shares.values()), 1 / 64)}


def pairs_of(kinds: Column) -> Column:
    return let(
        letters_of(kinds),
        lambda v: F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: F.concat(a, b)),
    )


@dataclass(frozen=True)
class Transitions:
    """By encoding: what each pair of kinds adds to a token's score, with its mean and deviation in random tokens."""

    weights: dict[tuple[int, str], float]
    means: dict[int, float]
    deviations: dict[int, float]

    def score(self, encoding: Column, kinds: Column) -> Column:
        """Standard normal for a random token, large for a structured one."""
        if not self.weights:
            return F.lit(0.0)
        of = {e: F.create_map(*[F.lit(x) for (k, pair), w in sorted(self.weights.items()) if k == e for x in (pair, w)]) for e in self.means}
        known, mean, deviation = F.lit(None), F.lit(0.0), F.lit(1.0)
        for e in self.means:
            known = F.when(encoding == e, of[e]).otherwise(known)
            mean = F.when(encoding == e, self.means[e]).otherwise(mean)
            deviation = F.when(encoding == e, self.deviations[e]).otherwise(deviation)
        n = F.greatest(F.length(kinds) - 1, F.lit(1)).cast("double")
        added = let(known, lambda m: F.aggregate(pairs_of(kinds), F.lit(0.0), lambda a, p: a + F.coalesce(F.try_element_at(m, p), F.lit(0.0))))
        return (added - n * mean) / (deviation * F.sqrt(n))


def learnt(scan: DataFrame) -> Transitions:
    """The transitions of structured tokens. The driver gets a count for each encoding and pair of kinds: 180 at most."""
    taught = scan.select(F.explode("secret_candidates").alias("c")).where(F.col("c.step") >= -math.log(TAUGHT_P) * STEPS)
    rows = taught.select(F.col("c.encoding").alias("e"), F.explode(pairs_of(F.col("c.kinds"))).alias("pair")).groupBy("e", "pair").count().collect()
    counts = {(r["e"], r["pair"]): r["count"] for r in rows if len(r["pair"]) == 2}
    pooled: dict[str, int] = {}
    for (_, pair), n in counts.items():
        pooled[pair] = pooled.get(pair, 0) + n
    if not counts:
        return Transitions({}, {}, {})
    weights, means, deviations = {}, {}, {}
    everything = sum(pooled.values())
    for e in range(len(ENCODINGS)):
        shares = random_shares(e)
        own = sum(n for (k, _), n in counts.items() if k == e)
        mean = square = total = 0.0
        for one in shares:
            for other in shares:
                q, pair = shares[one] * shares[other], one + other
                # Few tokens of an encoding are backed by those of all, and these by the random ones.
                general = (pooled.get(pair, 0) + 50 * max(q, 1e-4)) / (everything + 50)
                share = (counts.get((e, pair), 0) + 200 * general) / (own + 200)
                w = math.log(share / max(q, 1e-4))
                weights[e, pair] = w
                mean, square, total = mean + q * w, square + q * w * w, total + q
        means[e] = mean / total
        deviations[e] = math.sqrt(max(square / total - means[e] ** 2, 1e-6))
    return Transitions(weights, means, deviations)


def scored(scan: DataFrame, transitions: Transitions) -> Column:
    """Candidates as (start, end, encoding, size, orderly, score in steps, score by the root of the length)."""

    def one(c: Column) -> Column:
        def put(z: Column) -> Column:
            step = F.least(F.greatest(F.floor(z * SCORE_STEPS), F.lit(LOWEST)), F.lit(HIGHEST)).cast("int")
            effect = z / F.sqrt(F.greatest(F.length(c["kinds"]) - 1, F.lit(1)).cast("double"))
            orderly = c["step"] >= -math.log(ORDERLY_P) * STEPS
            return F.struct(c["start"], c["end"], c["encoding"], c["size"], orderly.alias("orderly"), step.alias("score"), effect.alias("effect"))

        return let(transitions.score(c["encoding"], c["kinds"]), put)

    return F.transform("secret_candidates", one)


def below(z: float) -> float:
    """P(Z <= z) of a standard normal variable."""
    return 0.5 * math.erfc(-z / math.sqrt(2))


def cut_of(counts: dict[int, int], effects: tuple[float, float], size: int) -> int | None:
    """The highest score step that is reported in a class, by its candidates at each step and the mean and deviation of
    the structured tokens' scores by the root of their length."""
    root = math.sqrt(max(2 ** (size / SIZES) - 1, 1))
    sure = sum(n for s, n in counts.items() if s > SURE * SCORE_STEPS)
    mean, deviation = effects
    structured = sure / max(1 - below((SURE / root - mean) / deviation), 0.05)
    at_most = {step: sum(n for s, n in counts.items() if s < step) for step in range(LOWEST, HIGHEST_CUT + 1)}
    random = min(2 * at_most[0], at_most[-SCORE_STEPS] / below(-1.0)) if at_most[0] >= ENOUGH else None
    for step in range(HIGHEST_CUT, LOWEST, -1):
        if not at_most[step]:
            return None
        z = step / SCORE_STEPS
        false = structured * below((z / root - mean) / deviation)
        if random is not None:
            noise = 2 * math.sqrt(at_most[step])  # what chance adds to a count
            false = max(false, at_most[step] - random * below(z) - noise)
        if false <= FALSE_SHARE * at_most[step]:
            return step
    return None


def cuts_from(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """By encoding and length class the score step below which tokens are reported. The driver gets one row for each
    class and step: five encodings, two lengths a doubling, 381 steps."""
    rows = (
        tokens.where(~F.col("orderly"))
        .groupBy("encoding", "size", "score")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("effect").alias("a"), F.sum(F.col("effect") ** 2).alias("b"))
        .collect()
    )
    counts: dict[tuple[int, int], dict[int, int]] = {}
    sums: dict[int, list[float]] = {}
    for r in rows:
        counts.setdefault((r["encoding"], r["size"]), {})[r["score"]] = r["n"]
        if r["score"] > SURE * SCORE_STEPS:
            for e in (r["encoding"], -1):
                held = sums.setdefault(e, [0.0, 0.0, 0.0])
                for k, x in enumerate((r["n"], r["a"], r["b"])):
                    held[k] += x
    out = {}
    for (e, size), held in counts.items():
        n, a, b = sums[e] if sums.get(e, [0])[0] >= ENOUGH else sums.get(-1, [0.0, 0.0, 0.0])
        mean = a / n if n else 1.0
        deviation = math.sqrt(max(b / n - mean * mean, 0.04)) if n else 0.3
        if (cut := cut_of(held, (mean, deviation), size)) is not None:
            out[e, size] = cut
    return out


def with_random(scan: DataFrame) -> DataFrame:
    """All rows of a stored scan with `secret_spans`: base spans and the candidates that count as random."""
    transitions = learnt(scan)
    judged = scan.withColumn("secret_candidates", scored(scan, transitions))
    cuts = cuts_from(judged.select(F.explode("secret_candidates").alias("c")).select("c.*"))
    kept = F.filter("secret_candidates", lambda c: F.lit(False))
    if cuts:
        known = F.create_map(*[x for (e, z), step in sorted(cuts.items()) for x in (F.lit(e * 1000 + z), F.lit(step))])
        least = F.lit(LOWEST - 1)
        kept = F.filter(
            "secret_candidates",
            lambda c: ~c["orderly"] & (c["score"] < F.coalesce(F.try_element_at(known, c["encoding"] * 1000 + c["size"]), least)),
        )
    random = F.transform(
        kept, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end"))
    )
    return judged.withColumn("secret_spans", F.concat("secret_base", random))


def spotted_in(rows: DataFrame) -> DataFrame:
    return with_random(stored(scanned(rows)))


def find_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """All rows with `secret_base` and `secret_spans`, arrays of (start, kind, end) in code points.

    Null and empty texts have none. Equal texts get equal spans. Kinds are numbered as in KINDS. Input columns of these
    names are replaced, others stay; an empty table stays empty. The scan is stored once; the corpus-wide cuts are
    taken from it.
    """
    return keeping(df, {"text": text}, spotted_in, ["secret_base", "secret_spans"])


def mask_secrets(df: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """All rows with their secrets replaced by a mask, overlapping ones by one; a null text stays null."""

    def body(rows: DataFrame) -> DataFrame:
        return spotted_in(rows).withColumn("text", masked(F.col("text"), F.col("secret_spans"), mask))

    return keeping(df, {"text": text}, body, [])


def op7_randomness_battery(spark, sf_dir: str) -> DataFrame:
    """Secrets of all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    spotted = with_random(stored(scanned(docs).drop("text")))
    base = F.col("secret_base")
    return spotted.select(
        "doc_id",
        count_of(base, 0).alias("n_assign"),
        count_of(base, 1).alias("n_access"),
        count_of(base, 2).alias("n_hex"),
        F.sha2(listed(base, KINDS), 256).alias("base_sha256"),
        listed(F.col("secret_spans"), KINDS).alias("spans"),
    )
