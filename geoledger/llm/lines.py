"""Line dedup: winnowing over line hashes.

A window is the shortest run of whole lines from a line on that holds 50 words or more. Its fingerprint is its least
line hash. Two equal windows have equal fingerprints, so every run of 50 words or more that repeats has one: a window
whose fingerprint stands in one place only cannot repeat and leaves. The others are joined by their content with the
first place of that content, by ascending document and line. Matches are then extended both ways, line by line, along
that first place, and the lines of later runs are deleted.

Line hashes travel, texts stay. Each window is joined with one first place, so copies make as many matches as windows.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoledger.llm.rows import documents, keeping, stored

#: Words of the shortest run that is deleted when it repeats.
RUN_WORDS = 50
#: Deleted runs, two numbers each, and repeated fingerprints, up to which they are broadcast: 32 MB. More are shuffled.
BROADCAST_RUNS = 1_000_000
#: A line's place: words before it in the upper half, its number in the lower half.
HALF = 1 << 32


def row_key(key: str, text: str) -> Column:
    """Rows with equal key and text are one document: they get the same result."""
    return F.xxhash64(F.col(key), F.col(text))


def words_of(line: Column) -> Column:
    """Words of a line, maximal runs of other characters than white space; only where white space follows white space do
    they differ from its spaces and one."""
    trimmed = F.trim(F.translate(line, "\t\r\x0b\x0c", "    "))
    spaces = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit("")))
    filled = F.contains(trimmed, F.lit("  "))
    return (
        F.when(trimmed == "", F.lit(0))
        .when(filled, F.regexp_count(trimmed, F.lit("[^ ]++")))
        .otherwise(spaces + 1)
        .cast("long")
    )


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(rid, owner, line, words, place, blanks, unit) of all lines that hold words; null texts have none.

    Blank lines go with the line behind them: `unit` holds their hashes and its own, `blanks` is their number. Those at
    the end of a text make a row without words. So a run of blank lines is one row, however long it is.
    """
    numbered = df.where(F.col(text).isNotNull()).select(
        row_key(key, text).alias("rid"),
        F.col(key).alias("owner"),
        F.posexplode(
            F.transform(
                F.split(F.col(text), "\n", -1), lambda x: F.struct(F.xxhash64(x).alias("hash"), words_of(x).alias("words"))
            )
        ).alias("line", "_l"),
    )
    before = Window.partitionBy("rid", "owner").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.col("words") > 0
    placed = (
        numbered.select("rid", "owner", "line", "_l.hash", "_l.words")
        .dropDuplicates(["rid", "owner", "line"])
        .withColumn("place", F.coalesce(F.sum("words").over(before), F.lit(0)) * HALF + F.col("line"))
        .withColumn("filled", F.coalesce(F.sum(filled.cast("int")).over(before), F.lit(0)))
    )
    runs = placed.groupBy("rid", "owner", "filled").agg(
        F.max(F.struct("line", "words", "place", "hash")).alias("_l"),
        F.sort_array(F.collect_list(F.when(~filled, F.struct("line", "hash")))).alias("_blank"),
    )
    own = F.when(F.col("_l.words") > 0, F.array("_l.hash")).otherwise(F.array().cast("array<bigint>"))
    return runs.select(
        "rid", "owner", "_l.line", "_l.words", "_l.place", F.size("_blank").alias("blanks"), F.concat("_blank.hash", own).alias("unit")
    )


def windows(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = RUN_WORDS) -> DataFrame:
    """One row for each line that opens a window: its last line, fingerprint, content hash and the lines around."""
    by_place = Window.partitionBy("rid", "owner").orderBy("place")
    inside = by_place.rangeBetween(0, least * HALF - 1)
    left, right = by_place.rangeBetween(-least * HALF, -1), by_place.rangeBetween(least * HALF, 2 * least * HALF - 1)
    listed = lines(df, key, text).select(
        "rid",
        "owner",
        "line",
        "blanks",
        "unit",
        F.col("words").alias("own_words"),
        F.max("line").over(inside).alias("last"),
        F.sum("words").over(inside).alias("held"),
        F.collect_list("unit").over(inside).alias("inside"),
        F.collect_list("unit").over(left).alias("left"),
        F.collect_list("unit").over(right).alias("right"),
    )
    # The blank lines before the first line stand in its unit, and to the left of the window.
    hashes = F.slice(F.flatten("inside"), F.col("blanks") + 1, F.lit(2**31 - 1))
    own = F.slice("unit", F.lit(1), F.col("blanks"))
    opened = listed.where((F.col("held") >= least) & (F.col("own_words") > 0)).withColumn("hashes", hashes)
    return opened.select(
        "rid",
        "owner",
        "line",
        "last",
        F.array_min("hashes").alias("fingerprint"),
        F.xxhash64("hashes").alias("content"),
        F.concat(F.flatten("left"), own).alias("left"),
        F.flatten("right").alias("right"),
    )


def common(one: Column, other: Column) -> Column:
    """How many elements two arrays share from their start."""
    differs = F.transform(F.arrays_zip(one.alias("a"), other.alias("b")), lambda x: ~x["a"].eqNullSafe(x["b"]))
    first = F.array_position(differs, F.lit(True))
    return F.when(first > 0, first - 1).otherwise(F.least(F.size(one), F.size(other))).cast("int")


def repeated_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = RUN_WORDS) -> DataFrame:
    """(rid, owner, from, to): lines of later repeated runs; runs may overlap."""
    found = stored(windows(df, key, text, least))
    place = F.struct("owner", "rid", "line")
    # Counted before they are sent, and apart from the windows, so that a frequent one is no large task.
    repeated = stored(found.groupBy("fingerprint").count().where("count > 1").select("fingerprint"))
    few = repeated.count() <= BROADCAST_RUNS
    suspects = found.join(F.broadcast(repeated) if few else repeated, "fingerprint", "left_semi")
    firsts = (
        suspects.groupBy("content")
        .agg(F.min(F.struct(place.alias("place"), "left", "right")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("content", "first")
    )
    later = suspects.join(firsts, "content").where(
        ~(place["owner"].eqNullSafe(F.col("first.place.owner")))
        | (F.col("rid") != F.col("first.place.rid"))
        | (F.col("line") != F.col("first.place.line"))
    )
    back = common(F.reverse("left"), F.reverse("first.left"))
    ahead = common(F.col("right"), F.col("first.right"))
    return later.select(
        "rid", "owner", (F.col("line") - back).cast("int").alias("from"), (F.col("last") + ahead).cast("int").alias("to")
    )


def merged_runs(runs: DataFrame) -> DataFrame:
    """Runs of a document that overlap or touch, as one."""
    order = Window.partitionBy("rid", "owner").orderBy("from", "to")
    reach = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("from") > reach + 1), 1).otherwise(0)
    return (
        runs.distinct()
        .withColumn("_opens", opens)
        .withColumn("_run", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("rid", "owner", "_run")
        .agg(F.min("from").alias("from"), F.max("to").alias("to"))
        .drop("_run")
    )


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = RUN_WORDS) -> DataFrame:
    """All rows, their text without the lines of later repeated runs, with n_lines and n_deleted.

    Documents are ordered by key, null keys first, then by a hash of their text; rows equal in key and text are one
    document and get the same result. A null text stays null with 0 lines; an empty one has one blank line. Blank lines
    count no words but belong to the run around them. Where nothing repeats the text is untouched. A very long text is
    as many rows as it has lines with words. Other columns stay; those named like an output column are replaced.
    """

    def body(rows: DataFrame) -> DataFrame:
        runs = stored(merged_runs(repeated_runs(rows.select("key", "text"), "key", "text", least)))
        few = runs.count() <= BROADCAST_RUNS
        by_row = runs.groupBy("rid", "owner").agg(F.collect_list(F.struct("from", "to")).alias("runs"))
        joined = rows.withColumn("own", row_key("key", "text")).join(
            F.broadcast(by_row) if few else by_row,
            (F.col("own") == F.col("rid")) & F.col("key").eqNullSafe(F.col("owner")),
            "left",
        )
        parts = F.split(F.col("text"), "\n", -1)
        left = F.filter(parts, lambda x, i: ~F.exists("runs", lambda r: (r["from"] <= i) & (i <= r["to"])))
        gone = F.aggregate(
            F.coalesce("runs", F.array()), F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"] + 1
        )
        return (
            joined.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long"))
            .withColumn("n_deleted", gone)
            .withColumn("text", F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
        )

    return keeping(df, {"key": key, "text": text}, body, ["n_lines", "n_deleted"])


def op6_winnowed_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the lines of runs of 50 words or more that an earlier place holds."""
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


#: The same for documents with keys of their own, by the lines themselves instead of hashes.
ORACLE = f"""
with line as (
 select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos
 from documents where text is not null
), counted as (
 select *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as words from line
), placed as (
 select *, coalesce(sum(words) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0)
  * {HALF} + pos as place from counted
), opened as (
 select doc_id, pos, words, max(pos) over inside as last, sum(words) over inside as held, list(line) over inside as content,
  coalesce(list(line) over before, []) as ahead_of, coalesce(list(line) over behind, []) as behind_it from placed
 window inside as (partition by doc_id order by place range between 0 preceding and {RUN_WORDS * HALF - 1} following),
  before as (partition by doc_id order by place range between {RUN_WORDS * HALF} preceding and 1 preceding),
  behind as (partition by doc_id order by place range between {RUN_WORDS * HALF} following and {2 * RUN_WORDS * HALF - 1} following)
), win as (select * from opened where held >= {RUN_WORDS} and words > 0),
firsts as (select content, min({{'d': doc_id, 'p': pos}}) as f from win group by content having count(*) > 1),
later as (
 select w.*, b.ahead_of as other_ahead, b.behind_it as other_behind from win w join firsts using (content)
 join win b on b.doc_id = f.d and b.pos = f.p where w.doc_id <> f.d or w.pos <> f.p
), reach as (
 select doc_id, pos, last, list_reverse(ahead_of) as a, list_reverse(other_ahead) as b, behind_it as c, other_behind as d from later
), runs as (
 select doc_id,
  pos - coalesce(list_min(list_filter(range(least(len(a), len(b))), lambda i: a[i + 1] <> b[i + 1])), least(len(a), len(b))) as lo,
  last + coalesce(list_min(list_filter(range(least(len(c), len(d))), lambda i: c[i + 1] <> d[i + 1])), least(len(c), len(d))) as hi
 from reach
), gone as (select distinct doc_id, unnest(range(lo, hi + 1)) as pos from runs),
kept as (
 select l.doc_id, coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where g.pos is null), '') as text,
  count(*) as n_lines, count(g.pos) as n_deleted
 from line l left join gone g on g.doc_id = l.doc_id and g.pos = l.pos group by l.doc_id
)
select doc_id, kept.text, coalesce(n_lines, 0) as n_lines, coalesce(n_deleted, 0) as n_deleted
from documents left join kept using (doc_id)
"""
