"""Exact Jaccard join of documents on word shingles: a size-aware heavy-light join.

A document is the set of its distinct five-word shingles. Two sets link when they share 80 % of their union.

Small sets are light. For each size a partner can have, a light set enumerates its subsets of the size that the two
must share. Equal subsets prove a link, so light sets need no comparison; the sets that meet in a key are linked to
its first one. Large sets are heavy and go into inverted lists. The boundary is the one with the least estimated cost
over the sizes at hand.

Heavy sets are narrowed in exact steps before sets are compared:

1. In the order of their hashes, linked sets share at least `shared_least` of their first `prefix` shingles. Each set
   lists that prefix; sets with fewer shingles in lists of several sets have no link and leave. One scan, one shuffle.
2. A link between different components needs 80 % of a set's shingles to occur in another component. Sets with that
   many list the rarest shingles that the bound allows. Each is compared with one hub of its lists, the set most like
   the others, which joins most groups of near copies without comparing all pairs within them. Components are found
   and the step is repeated on what is left, fewer sets each time.
3. At last all pairs of different components in a list are compared, but for those that sizes and common shingles rule
   out, so that no link is lost.

Sets are known by a 64-bit hash of their content, shingles by 64-bit hashes of their words. Equal sets are one node
throughout, however many documents have them. A list entry that repeats within a block of documents is counted there
and sent once, so a frequent shingle or a group of copies is as many rows as there are blocks, not documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoledger.llm.graph import components
from geoledger.llm.rows import documents, keeping, ship, stored, text_of

WORDS = 5
#: Documents, and list entries, that a task combines before it sends them.
BLOCK_DOCS = 4096
BLOCK_ENTRIES = 1 << 20
#: Largest size the boundary may take, and the cost of a heavy list entry in enumerated subsets.
MOST_LIGHT = 20
ENTRY_COST = 4
#: More than any light size; two sizes fit in one number.
SIZES = 64
#: Rows of two longs up to which a side is broadcast: 32 MB. Larger ones are shuffled.
BROADCAST_ROWS = 2_000_000
#: Rounds of comparison with a hub before all pairs of what is left.
STAR_ROUNDS = 1
DOC, ENTRY, MET, LIGHT, LINK = range(5)
SENT = "k long, kind int, sid long, other long, n long"
FOUND = "kind int, sid long, other long, n long"


def least_overlap(n: int, m: int) -> int:
    """The least intersection with which sets of these sizes link."""
    return -(-4 * (n + m) // 9)


def own_least(n: int) -> int:
    """The least intersection of a set of this size with any set it links to."""
    return -(-4 * n // 5)


def slack(n: int) -> int:
    return max(1, n // 10)


def prefix(n: int) -> int:
    return n - own_least(n) + slack(n)


def shared_least(n: int) -> int:
    """How many entries of its prefix a set of this size shares with any set it links to."""
    return slack(own_least(n))


def partners(n: int) -> range:
    """Sizes of sets that a set of size n can link to."""
    return range(own_least(n), n * 5 // 4 + 1)


def subsets(n: int, most: int) -> int:
    """How many keys a light set of this size writes."""
    return sum(comb(n, o) for m in partners(n) if m <= most and (o := least_overlap(n, m)) <= min(n, m) and (m != n or o < n))


def boundary(sizes: dict[int, int]) -> int:
    """The largest light size with the least cost. Sizes within 80 % below it are listed as heavy ones too."""

    def cost(most: int) -> int:
        light = sum(k * subsets(n, most) for n, k in sizes.items() if n <= most)
        heavy = sum(k * ENTRY_COST * prefix(n) for n, k in sizes.items() if n >= own_least(most + 1))
        return light + heavy

    return min(range(1, MOST_LIGHT + 1), key=lambda most: (cost(most), most))


def shingles(text: str):
    """The sorted distinct shingle hashes of a text; of fewer than five words the whole sequence is one."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "u8")
    units = np.fromiter(map(xxh3_64_intdigest, words), "u8", len(words))
    width = min(WORDS, len(units))
    rolled = np.full(len(units) - width + 1, width, "u8")
    for k in range(width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + units[k : len(units) - width + 1 + k]
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(32)
    return np.unique(rolled)


def set_id(hashes) -> int:
    """A signed 64-bit id of a set's content; 0 for the empty one."""
    from xxhash import xxh3_64_digest

    return int.from_bytes(xxh3_64_digest(hashes.tobytes()), "little", signed=True) if len(hashes) else 0


def light_keys(hashes, most: int) -> list[tuple[int, int]]:
    """Keys of the subsets a light set may share with a partner of a light size, and that size."""
    from itertools import combinations

    from xxhash import xxh3_64_digest

    n, out = len(hashes), []
    units = [h.tobytes() for h in hashes]
    for m in partners(n):
        o = least_overlap(n, m)
        if m > most or o > min(n, m) or (m == n and o == n):
            continue
        head = bytes([min(n, m), max(n, m)])
        for chosen in combinations(units, o):
            key = int.from_bytes(xxh3_64_digest(head + b"".join(chosen)), "little", signed=True)
            out.append((key, m))
    return out


def combined(keys, sids):
    """Entries of a block: (key, sid) to send, whether each is already counted, and counted (sid, times).

    In a list of several sets all are counted here; the first and the last go on, so that others can be counted."""
    import numpy as np

    order = np.lexsort((sids, keys))
    keys, sids = keys[order], sids[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (sids[1:] != sids[:-1])]
    keys, sids = keys[new], sids[new]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(np.r_[starts, len(keys)])
    single, several = starts[counts == 1], starts[counts > 1]
    ends = several + counts[counts > 1] - 1
    at = np.r_[single, several, ends]
    done = np.r_[np.zeros(len(single), "i8"), np.ones(2 * len(several), "i8")]
    return keys[at], sids[at], done, np.unique(sids[np.repeat(counts > 1, counts)], return_counts=True)


def listing(most: int):
    """For mapInArrow over (doc_id, text): documents, entries of inverted lists and keys of light sets."""
    heavy_from = own_least(most + 1)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest

        names = ["k", "kind", "sid", "other", "n"]

        def rows(kind, k, sid, other, n):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.asarray(k, "i8")),
                    pa.array(np.full(len(k), kind, "i4")),
                    pa.array(np.asarray(sid, "i8")),
                    pa.nulls(len(k), pa.int64()) if other is None else pa.array(other, pa.int64()),
                    pa.array(np.asarray(n, "i8")),
                ],
                names,
            )

        def block(docs, entries, light) -> Iterator:
            if docs:
                place = [xxh3_64_intdigest(repr(d).encode()) >> 1 for d in docs]
                yield rows(DOC, place, [d[1] for d in docs], [d[0] for d in docs], [d[2] for d in docs])
            if entries:
                keys = np.concatenate([k for k, _ in entries]).view("i8")
                sids = np.repeat([s for _, s in entries], [len(k) for k, _ in entries])
                k, s, done, near = combined(keys, sids)
                yield rows(ENTRY, k, s, done, np.zeros(len(k)))
                yield rows(MET, near[0], near[0], None, near[1])
            if light:
                firsts: dict[tuple[int, int, int], int] = {}
                links = set()
                for key, n, m, sid in sorted(light):
                    if (head := firsts.setdefault((key, n, m), sid)) != sid:
                        links.add((key, n, m, sid, head))
                # Sets of one size in a key of two sizes need not link to each other; the first stands for them.
                sent = [(k, s, k, n * SIZES + m) for (k, n, m), s in firsts.items()]
                sent += [(k, s, k, n * SIZES + m) for k, n, m, s, _ in links if n != m]
                yield rows(LIGHT, *zip(*sent, strict=True))
                if same := {(s, h) for _, n, m, s, h in links if n == m}:
                    yield rows(LINK, *zip(*[(s, s, h, 0) for s, h in sorted(same)], strict=True))

        docs, entries, light, size = [], [], [], 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                hashes = shingles(texts[i].as_py())
                n, sid = len(hashes), set_id(hashes)
                docs.append((keys[i].as_py(), sid, n))
                if n >= heavy_from:
                    entries.append((hashes[: prefix(n)], sid))
                    size += prefix(n)
                if 0 < n <= most:
                    light += [(k, n, m, sid) for k, m in light_keys(hashes, most)]
                if len(docs) >= BLOCK_DOCS or size >= BLOCK_ENTRIES:
                    yield from block(docs, entries, light)
                    docs, entries, light, size = [], [], [], 0
        yield from block(docs, entries, light)

    return run


def meeting(batches) -> Iterator:
    """For mapInArrow over rows in order of k: how often each set is in a list of several; other rows pass."""
    import numpy as np
    import pyarrow as pa

    names = ["kind", "sid", "other", "n"]

    def met(k, sid, done):
        """The sets that whole lists in order count, with repeats."""
        order = np.lexsort((done, sid, k))
        k, sid, done = k[order], sid[order], done[order]
        last_of = np.r_[(k[1:] != k[:-1]) | (sid[1:] != sid[:-1]), True]  # counted in a block, if at all, sorts last
        k, sid, done = k[last_of], sid[last_of], done[last_of]
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        counts = np.diff(np.r_[starts, len(k)])
        return sid[np.repeat(counts > 1, counts) & (done == 0)]

    def counted(parts):
        sid, times = np.unique(np.concatenate(parts), return_counts=True)
        kind, other = pa.array(np.full(len(sid), MET, "i4")), pa.nulls(len(sid), pa.int64())
        return pa.RecordBatch.from_arrays([kind, pa.array(sid), other, pa.array(times.astype("i8"))], names)

    held = [np.zeros(0, "i8")] * 3
    found, waiting = [], 0
    for batch in batches:
        kind = batch.column(1).to_numpy()
        passing = np.flatnonzero(kind != ENTRY)
        if len(passing):
            b = batch.take(pa.array(passing))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in (1, 2, 3, 4)], names)
        entries = np.flatnonzero(kind == ENTRY)
        if not len(entries):
            continue
        b = batch.take(pa.array(entries))
        k, sid, done = (np.r_[h, b.column(c).to_numpy()] for h, c in zip(held, (0, 2, 3), strict=True))
        whole = int(np.searchsorted(k, k[-1]))  # the last list may go on
        held = [x[whole:] for x in (k, sid, done)]
        if whole:
            found.append(met(k[:whole], sid[:whole], done[:whole]))
            waiting += len(found[-1])
        if waiting > BLOCK_ENTRIES:
            yield counted(found)
            found, waiting = [], 0
    if len(held[0]):
        found.append(met(*held))
    if found:
        yield counted(found)


def listed_sets(batches) -> Iterator:
    """For mapInArrow over (text): the id, size and shingles of each text's set."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column(0)]
        for lo in range(0, len(sets), 256):
            part = sets[lo : lo + 256]
            ends = np.cumsum([0, *map(len, part)])
            values = np.concatenate(part) if part else np.zeros(0, "u8")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(x) for x in part], pa.int64()),
                    pa.array([len(x) for x in part], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view("i8"))),
                ],
                ["sid", "n", "shingles"],
            )


def small(df: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if its counted rows are few enough; Spark shuffles it otherwise."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids that link, by their whole sets."""
    one = sets.select(F.col("sid").alias("a"), F.col("n").alias("_na"), F.col("shingles").alias("_a"))
    two = sets.select(F.col("sid").alias("b"), F.col("n").alias("_nb"), F.col("shingles").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .where(F.lit(100) * both >= F.lit(80) * (F.col("_na") + F.col("_nb") - both))
        .select("a", "b")
    )


def own_least_of(n: Column) -> Column:
    return F.ceil(F.lit(4) * n / 5).cast("long")


def rare_lists(current: DataFrame) -> DataFrame:
    """(place, h, sid, n, component, common, list) of the rarest shingles by which a set can link to another component.

    `common` counts the shingles that another component has too, the most it can share with one. Shingles of one
    component alone come first in the order and need no list. Of the others, by rising count, a set lists as many as
    remain of the n - least + 1 that any link must share one of.
    """
    spread = current.select("sid", "n", "component", F.explode("shingles").alias("h"))
    counts = (
        spread.groupBy("h")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("df"))
        .where("lo <> hi")
        .select("h", "df")
    )
    shared = (
        spread.join(counts, "h")
        .groupBy("sid", "n", "component")
        .agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("shared"))
        .withColumn("common", F.size("shared").cast("long"))
    )
    room = F.col("common") - own_least_of(F.col("n")) + 1
    listed = F.transform(F.slice("shared", F.lit(1), F.greatest(room, F.lit(0)).cast("int")), lambda x: x["h"])
    return (
        shared.where(room > 0)
        .select("sid", "n", "component", "common", listed.alias("list"))
        .select(F.posexplode("list").alias("place", "h"), "sid", "n", "component", "common", "list")
    )


def star_pairs(lists: DataFrame) -> DataFrame:
    """Each set with the hub that it meets most often: the set of a list that has most of its shingles in common with
    others, such as the original of a group of edited copies. Sets of the hub's own component need no pair."""
    share = F.col("common") / F.col("n")
    hubs = lists.groupBy("h").agg(F.max(F.struct(share.alias("share"), "sid", "component")).alias("hub"))
    return (
        lists.join(hubs, "h")
        .where(F.col("component") != F.col("hub.component"))
        .groupBy("sid", F.col("hub.sid").alias("b"))
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("sid")
        .agg(F.max_by("b", F.struct("times", "b")).alias("b"))
        .select(F.col("sid").alias("a"), "b")
    )


def all_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of different components that can link by their sizes and by what each has in common with others; a pair
    comes from the first list that both are in."""
    names = ("sid", "n", "component", "common", "place", "list")
    other = lists.select("h", *[F.col(c).alias(f"{c}2") for c in names])
    # What stands before the first shingle that both list is not shared.
    able = "9 * least(common - place, common2 - place2) >= 4 * (n + n2)"
    first = "element_at(array_intersect(list, list2), 1) = h"
    return (
        lists.join(other, "h")
        .where(f"sid < sid2 AND component <> component2 AND {able} AND {first}")
        .select(F.col("sid").alias("a"), F.col("sid2").alias("b"))
    )


def light_links(found: DataFrame) -> DataFrame:
    """Links of light sets by equal subsets: across the sizes of a key of two, to the first of a key of one."""
    rows = found.where(F.col("kind") == LIGHT).select(
        F.col("other").alias("key"),
        F.floor(F.col("n") / SIZES).alias("size"),
        F.pmod(F.col("n"), F.lit(SIZES)).alias("partner"),
        F.col("sid").alias("a"),
    )
    heads = rows.groupBy("key", "size").agg(F.min("a").alias("b"))
    met = rows.join(heads.withColumnRenamed("size", "partner"), ["key", "partner"])
    inside = found.where(F.col("kind") == LINK).select(F.col("sid").alias("a"), F.col("other").alias("b"))
    return met.where("a <> b").select("a", "b").union(inside).distinct()


def light_boundary(df: DataFrame, text: str) -> int:
    """The boundary for the sizes of a table, from the word counts of its short texts: at most as many rows as there
    are sizes up to the largest light one come to the driver. Any boundary gives the same links."""
    most = MOST_LIGHT * 2
    short = df.where(F.octet_length(text) <= 12 * most)
    words = F.size(F.filter(F.split(F.col(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    size = F.greatest(words - (WORDS - 1), F.lit(1))
    counts = short.where(words > 0).groupBy(size.alias("n")).count().where(F.col("n") <= most).collect()
    return boundary({r["n"]: r["count"] for r in counts})


def grouped(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, sid, n_shingles, component, component_id) of all rows: see linked()."""
    ship(df.sparkSession)
    rows = df.select(df[key].cast("long").alias("doc_id"), text_of(text).alias("text"))
    most = light_boundary(rows, "text")
    found = stored(
        rows.mapInArrow(listing(most), SENT)
        .repartition("k")
        .sortWithinPartitions("k")
        .mapInArrow(meeting, FOUND)
    )
    docs = found.where(F.col("kind") == DOC).select(F.col("other").alias("doc_id"), "sid", "n")
    nodes = docs.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"))
    edges = light_links(found)

    asked = F.greatest(F.lit(1), F.floor(own_least_of(F.col("n")) / 10)).cast("long")  # shared_least
    met = found.where(F.col("kind") == MET).groupBy("sid").agg(F.sum("n").alias("met"))
    left = stored(met.join(nodes, "sid").where(F.col("met") >= asked).select("sid", "doc_id"))
    wanted = small(left.select(F.col("doc_id").alias("_wanted")).distinct())
    chosen = rows.join(wanted, rows["doc_id"].eqNullSafe(F.col("_wanted")), "left_semi").select("text")
    sets = stored(
        chosen.mapInArrow(listed_sets, "sid long, n long, shingles array<long>")
        .join(small(left.select("sid")), "sid", "left_semi")
        .dropDuplicates(["sid"])
    )
    edges = stored(edges)

    current = sets
    for turn in range(STAR_ROUNDS + 1):
        parts = components(edges)
        labelled = current.join(parts, current["sid"] == parts["node"], "left").select(
            "sid", "n", "shingles", F.coalesce("component", "sid").alias("component")
        )
        lists = stored(rare_lists(labelled))
        if lists.isEmpty():
            break
        pairs = star_pairs(lists) if turn < STAR_ROUNDS else all_pairs(lists)
        current = stored(current.join(lists.select("sid").distinct(), "sid", "left_semi"))
        edges = stored(edges.union(verified(pairs, current)))
    parts = components(edges)
    named = (
        nodes.join(parts, nodes["sid"] == parts["node"], "left")
        .select("sid", "doc_id", F.coalesce("component", "sid").alias("component"))
    )
    least_key = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_set = named.join(least_key, "component").select("sid", "component", "component_id")
    return docs.join(by_set, "sid", "left").select(
        "doc_id",
        "sid",
        F.col("n").alias("n_shingles"),
        "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def linked(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of all rows.

    A component is named by its least key. Empty and null texts have no shingles, link with nothing and are named by
    themselves. Rows with one key are each in the component of their own text; null keys name no component unless it
    has no other. Other columns are left out, an empty table gives no rows.
    """
    return grouped(df, key, text).select("doc_id", "n_shingles", "component_id")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of which one of each component is left: that of the least key, or of equal keys that of the least hash
    of its text. Rows without words all stay. Columns stay as they are."""
    found = stored(grouped(df, key, text))
    odd = found.groupBy("doc_id").count().where(F.col("doc_id").isNull() | (F.col("count") > 1))
    set_of = F.pandas_udf(lambda texts: texts.map(lambda t: set_id(shingles(t))).astype("int64"), T.LongType())

    def by_key(rows: DataFrame) -> DataFrame:
        gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone"))
        return rows.join(small(stored(gone)), F.col("key").cast("long") == F.col("gone"), "left_anti")

    def by_text(rows: DataFrame) -> DataFrame:
        """Keys that are null or repeat name no row, so rows are told apart by their texts as well."""
        known = found.select("sid", "component").distinct()
        marked = rows.withColumn("own", set_of(text_of("text"))).withColumn("hash", F.xxhash64("text"))
        wordy = marked.where("own <> 0").join(known, F.col("own") == F.col("sid"))
        place = F.struct(F.col("key").isNull().alias("a"), F.col("key").alias("b"), F.col("hash").alias("c"))
        firsts = wordy.groupBy(F.col("component").alias("c")).agg(F.min(place).alias("first"))
        chosen = (
            wordy.join(firsts, F.col("component") == F.col("c"))
            .where(F.col("key").eqNullSafe(F.col("first.b")) & (F.col("hash") == F.col("first.c")))
            .dropDuplicates(["component"])
        )
        return chosen.select(*rows.columns).unionByName(marked.where("own = 0").select(*rows.columns))

    return keeping(df, {"key": key, "text": text}, by_key if odd.isEmpty() else by_text, [])


def op9_size_aware_jaccard(spark, sf_dir: str) -> DataFrame:
    """Components of all documents by links of shingle Jaccard 0.8 or more."""
    return linked(documents(spark, sf_dir))
