"""Near-duplicate classes by BagMinHash signatures, banding and exact multiset overlap.

A text is the multiset of its runs of five words. Each run is an element, its count the weight, and the weights are discretised
to whole levels. An element has one Poisson process for each dyadic range of levels ([0,1), [1,2), [2,4), ..), seeded by the
element and the range, so all texts see the same points. A point has a time, a signature component and a level; it
counts for a text if the level lies below the element's weight there (thinning within the topmost range). A
component's value is its earliest counted point. Two texts agree in a component with a probability equal to their weighted
Jaccard similarity. Points come in ascending time and stop at the latest component, so a long text costs
about one point per element.

1. One pass over the texts gives a 128-bit fingerprint of the multiset and ``BANDS`` band keys. Equal multisets collapse.
2. Texts that share a bucket (band and key) are candidates. Every text is compared with the leader of each of its buckets, the text with the most
   neighbours in all: one pair a text and bucket, however large the group. Buckets of at most ``SMALL`` texts are compared in full.
   Every pair is verified on the whole multisets: a link needs a weighted Jaccard similarity of ``SIMILARITY``.
3. Texts go to the class of the leader they are linked with. Of each larger bucket, one text of each class stays, and buckets of one class go. At most ``ROUNDS``
   more rounds compare these texts with a random one of them, and contract again, so the table shrinks from round to round.
4. The rounds only save work: texts of larger buckets that still hold several classes then go through an exact prefix filter. Units are
   ordered by the number of these texts that hold them, rarest first; two texts can only be linked if their first common unit
   stands early enough in both. Every such pair of different classes is verified, so no pair that shares a bucket is lost.
5. All links together give the final classes (large-star, small-star).

Each step is a written table, so no step is computed twice and lost tasks start from files.
"""

from __future__ import annotations

from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.blocks import small_batches
from tributary.llm.words import U, full_grams, gram_hashes, mix, split_words, steps
from tributary.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8
#: A pair at the similarity shares no bucket with a probability of (1 - 0.8 ** ROWS) ** BANDS = 7e-6.
BANDS, ROWS = 30, 5
COMPONENTS = BANDS * ROWS
#: Largest bucket that is compared in full.
SMALL = 9
#: Rounds over larger buckets between the first comparison and the filter.
ROUNDS = 2
#: A pair of texts, the class of the one and that of its leader so far, and a rank among leaders.
LINK = ["a", "b", "child", "parent", "rank"]
LINK_SCHEMA = ", ".join(f"{c} bigint" for c in LINK)
_STEP = U(0x9E3779B97F4A7C15)


def shingles(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(text, element, weight, number of texts): distinct runs of five words, in order of text and element. A text of one to four
    words has one element, all its words."""
    words = split_words(texts)
    hashes = words.hashes()
    inside = full_grams(words.text, SHINGLE)
    element, text = gram_hashes(hashes, SHINGLE)[inside], words.text[: len(inside)][inside]
    per_text = words.per_text
    ends = np.cumsum(per_text)
    short = np.flatnonzero((per_text > 0) & (per_text < SHINGLE))
    if len(short):
        own = np.array([gram_hashes(hashes[ends[t] - per_text[t] : ends[t]], int(per_text[t]))[0] for t in short], U)
        element, text = np.concatenate([element, own]), np.concatenate([text, short])
    order = np.argsort(element)
    order = order[np.argsort(text[order].astype(np.uint16 if words.n_texts < 1 << 16 else np.int64), kind="stable")]
    element, text = element[order], text[order]
    new = np.concatenate([[True], (element[1:] != element[:-1]) | (text[1:] != text[:-1])])[: len(element)]
    first = np.flatnonzero(new)
    return text[first], element[first], np.diff(np.append(first, len(element))), words.n_texts


def units(element: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One hash for each copy of each element, so that multiset overlap is set overlap."""
    copy = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
    return mix(np.repeat(element, weight) + copy.astype(U) * _STEP)


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, components: int = COMPONENTS) -> np.ndarray:
    """BagMinHash values (times) of each text; infinite without elements."""
    values = np.full((n_texts, components), np.inf)
    # One process for each element and dyadic range of levels below its weight.
    ranges = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    which = np.repeat(np.arange(len(element)), ranges)
    level = np.arange(len(which)) - np.repeat(np.cumsum(ranges) - ranges, ranges)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.maximum(low, 1).astype(float)
    seed, owner = mix(element[which] + level.astype(U) * U(0xD1B54A32D192ED03)), text[which]
    top, time = weight[which], np.zeros(len(which))
    done, chunk = 0, 1
    while len(owner):
        # The next points of all processes that may still matter.
        index = U(done + 1) + np.arange(chunk, dtype=U)
        bits = mix(seed[:, None] + index * _STEP)
        gap = -np.log1p(-(bits >> U(11)).astype(float) * 2.0**-53) / (components * width)[:, None]
        at = time[:, None] + np.cumsum(gap, axis=1)
        other = mix(bits + U(1))
        component = ((other >> U(32)) * U(components)) >> U(32)
        counted = low[:, None] + (((other & U(0xFFFFFFFF)).astype(float) * 2.0**-32) * width[:, None]).astype(np.int64) < top[:, None]
        place = owner[:, None] * components + component.astype(np.int64)
        np.minimum.at(values.reshape(-1), place[counted], at[counted])
        time = at[:, -1]
        active = time < values.max(axis=1)[owner]
        seed, owner, top, time, low, width = seed[active], owner[active], top[active], time[active], low[active], width[active]
        done, chunk = done + chunk, min(64, 2 * chunk) if done > 2 else 1
    return values


def _sign(batches):
    for batch in batches:
        for part in steps(batch, "text"):
            text, element, weight, n = shingles(part["text"])
            values = signatures(text, element, weight, n).view(U).reshape(n, BANDS, ROWS)
            keys = np.zeros((n, BANDS), U)
            for r in range(ROWS):
                keys = mix(keys * U(31) + values[:, :, r])
            own = units(element, weight)
            of_text = np.repeat(text, weight)
            print_ = np.zeros((2, n), U)
            if len(own):
                first = np.flatnonzero(np.concatenate([[True], of_text[1:] != of_text[:-1]]))
                print_[0][of_text[first]] = np.add.reduceat(own, first)
                print_[1][of_text[first]] = np.add.reduceat(mix(own ^ _STEP), first)
            some = np.bincount(of_text, minlength=n) > 0
            offsets = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
            yield pa.record_batch({
                "doc_id": part["doc_id"].combine_chunks(), "p0": print_[0].view(np.int64), "p1": print_[1].view(np.int64),
                "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].reshape(-1).view(np.int64))),
            })


def _bags(batches):
    for batch in batches:
        for part in steps(batch, "text"):
            text, element, weight, n = shingles(part["text"])
            own, of_text = units(element, weight), np.repeat(text, weight)
            each = np.split(own, np.cumsum(np.bincount(of_text, minlength=n))[:-1])
            yield pa.record_batch({"doc_id": part["doc_id"].combine_chunks(), "bag": pa.array([np.sort(x).tobytes() for x in each], pa.binary())})


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays of units."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not len(short):
        return 0.0
    place = np.minimum(np.searchsorted(long, short), len(long) - 1)
    both = int((long[place] == short).sum())
    return both / (len(a) + len(b) - both)


def _verify(batches):
    for batch in batches:
        a, b = batch["bag_a"], batch["bag_b"]
        right = [similarity(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)) >= SIMILARITY for x, y in zip(a, b)]
        yield batch.select(LINK).filter(pa.array(right, pa.bool_()))


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of links (a, b): root is the smallest node that a node hangs together with. Roots themselves have no row."""

    def directed(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def stars(df: DataFrame) -> bool:
        """Whether each node has one root, and no root has one of its own."""
        roles = df.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(df.select("b", F.lit(0), F.lit(1)))
        both = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return both.where("up + down > 1 AND up > 0").isEmpty()

    edges = _saved(directed(links), "links")
    while not stars(edges):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))  # large-star
        large = directed(large.union(edges.select("a", "b").join(least, "a").select("a", F.col("m").alias("b"))))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest)  # small-star
        edges = _saved(directed(small), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _buckets(alike: DataFrame) -> DataFrame:
    """(band, key, rep, n, near): buckets of at least two texts, their sizes, and the neighbours of each text in all its bands."""
    rows = alike.select("rep", F.posexplode("bands").alias("band", "key"))
    sizes = rows.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = rows.join(sizes, ["band", "key"])
    return shared.select("band", "key", "rep", "n", F.sum("n").over(Window.partitionBy("rep")).alias("near"))


def _pairs(met: DataFrame) -> DataFrame:
    """Each pair of m and leader (rep, class, rank), the larger id in front."""
    one, two = F.col("m.rep"), F.col("leader.rep")
    return met.select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b"), F.col("m.class").alias("child"), F.col("leader.class").alias("parent"), F.col("leader.rank").alias("rank"))


def _first_pairs(members: DataFrame) -> DataFrame:
    """Each text with the leader of each of its buckets."""
    best = F.max(F.struct(F.col("near").alias("rank"), (-F.col("rep")).alias("r"))).alias("l")
    leaders = members.groupBy("band", "key").agg(best).select("band", "key", F.struct((-F.col("l.r")).alias("rep"), (-F.col("l.r")).alias("class"), "l.rank").alias("leader"))
    met = members.select("band", "key", F.struct("rep", F.col("rep").alias("class")).alias("m")).join(leaders, ["band", "key"])
    return _pairs(met.where("m.rep <> leader.rep"))


def _full(members: DataFrame) -> DataFrame:
    """All pairs of buckets of at most SMALL texts."""
    groups = members.where(F.col("n") <= SMALL).groupBy("band", "key").agg(F.sort_array(F.collect_set("rep")).alias("g"))
    one = groups.select("g", F.posexplode("g").alias("i", "a"))
    both = one.select("a", F.explode(F.slice("g", F.lit(1), F.col("i"))).alias("b"))
    return both.select("a", "b", F.col("a").alias("child"), F.col("b").alias("parent"), F.lit(0).cast("bigint").alias("rank"))


def _parted(rows: DataFrame) -> DataFrame:
    """(band, key, class, rep): one text of each class of each bucket, of buckets that hold several classes."""
    one = rows.groupBy("band", "key", "class").agg(F.min("rep").alias("rep"))
    several = one.groupBy("band", "key").agg(F.count("*").alias("k")).where("k > 1")
    return _saved(one.join(several.drop("k"), ["band", "key"]), "parted")


def _led(parted: DataFrame, salt: int) -> DataFrame:
    """In each bucket, the text of each class with a random one of them."""
    order = F.struct(F.xxhash64("rep", "band", F.lit(salt)).alias("rank"), "rep", "class")
    leaders = parted.groupBy("band", "key").agg(F.min(order).alias("leader"))
    met = parted.select("band", "key", F.struct("rep", "class").alias("m")).join(leaders, ["band", "key"])
    return _pairs(met.where("m.class <> leader.class"))


def _hubs(found: DataFrame) -> DataFrame:
    """(node, root): where each class goes, to that of its leader of highest rank, or to that leader's own."""
    best = F.max(F.struct("rank", (-F.col("parent")).alias("p"))).alias("h")
    up = _saved(found.groupBy("child").agg(best).select(F.col("child").alias("node"), (-F.col("h.p")).alias("root")), "hubs")
    higher = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
    back = F.col("top") == F.col("node")  # two that lead each other
    return up.join(higher, "root", "left").select("node", F.when(back, F.least("node", "root")).otherwise(F.coalesce("top", "root")).alias("root"))


def _moved(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows with the root of their class."""
    at = roots.select(F.col("node").alias("class"), "root")
    return rows.join(at, "class", "left").withColumn("class", F.coalesce("root", "class")).drop("root")


def _units(batches):
    for batch in batches:
        bags = [np.frombuffer(x.as_buffer(), U) for x in batch["bag"]]
        sizes = np.array([len(x) for x in bags], np.int64)
        own = np.array([x.sum(dtype=U) for x in bags], U).view(np.int64)
        each = {"rep": batch["rep"].to_numpy(), "class": batch["class"].to_numpy(), "own": own, "size": sizes}
        ends = np.cumsum(sizes)
        at = 0
        while at < len(bags):  # flat rows of bounded bytes, or one longer text
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 17), side="right")))
            flat = {k: np.repeat(v[at:stop], sizes[at:stop]) for k, v in each.items()}
            yield pa.record_batch(flat | {"unit": np.concatenate(bags[at:stop]).view(np.int64)})
            at = stop


def _prefixes(texts: DataFrame) -> DataFrame:
    """(rep, class, own, size, unit, place, short): the units by which each text (rep, class, bag) can meet another, and their places
    (from 1) in the order of rarity. short: early enough to meet a longer text too."""
    flat = _saved(texts.mapInArrow(_units, "rep bigint, class bigint, own bigint, size bigint, unit bigint"), "units")
    # A unit of one text stands in front and meets nothing: it only moves the places of the others.
    held = flat.groupBy("unit").agg(F.count("*").alias("df")).where("df > 1")
    shared = flat.join(held, "unit").groupBy("rep", "class", "own", "size").agg(F.sort_array(F.collect_list(F.struct("df", "unit"))).alias("g"))
    alone = F.col("size") - F.size("g")
    reach = lambda share: F.col("size") - F.ceil(share * F.col("size") - 1e-6) + 1
    first = shared.select("*", alone.alias("alone"), reach(SIMILARITY).alias("last")).where("last > alone")
    rows = first.select("rep", "class", "own", "size", "alone", F.posexplode(F.slice("g", F.lit(1), (F.col("last") - F.col("alone")).cast("int"))).alias("i", "u"))
    placed = rows.select("rep", "class", "own", "size", F.col("u.unit").alias("unit"), (F.col("alone") + F.col("i") + 1).alias("place"))
    return placed.withColumn("short", F.col("place") <= reach(2 * SIMILARITY / (1 + SIMILARITY)))


def _filtered(texts: DataFrame) -> DataFrame:
    """All pairs (a, b) of different classes among the texts (rep, class, bag) that may be linked, by prefixes and places.

    At each unit the texts of its most common class meet the others only, so pairs of one class are never more than those of two."""
    placed = _saved(_prefixes(texts), "prefixes")
    counts = placed.groupBy("unit", "class").agg(F.count("*").alias("n"))
    tops = counts.groupBy("unit").agg(F.max(F.struct("n", "class")).alias("t"), F.count("*").alias("k")).where("k > 1")
    met = _saved(placed.join(tops.select("unit", F.col("t.class").alias("top")), "unit"), "met")
    order = lambda s: F.struct(f"{s}.size", f"{s}.rep", f"{s}.own")
    need = F.ceil(SIMILARITY / (1 + SIMILARITY) * (F.col("x.size") + F.col("y.size")) - 1e-6)
    left = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place")) + 1
    able = (F.col("x.class") != F.col("y.class")) & (order("x") < order("y")) & (left >= need) & (F.col("x.size") >= SIMILARITY * F.col("y.size") - 1e-6)
    found, rest = [], "class <> top"
    for x, y in ((met.where("short").where(rest), met), (met.where("short"), met.where(rest))):
        both = x.alias("x").join(y.alias("y"), (F.col("x.unit") == F.col("y.unit")) & able)
        found.append(both.select(F.struct("x.rep", "x.class").alias("m"), F.struct("y.rep", "y.class", F.lit(0).cast("bigint").alias("rank")).alias("leader")))
    return _pairs(found[0].union(found[1])).where("a <> b")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id) of every row: class_id is the smallest id among the documents that hang together by links.

    Texts without words (null, empty, blank) are linked to nothing: their class is their own id. Texts of one to four words link to
    those with the same words only. Rows with a null id have a null class. Rows that repeat an id are one document each and hang together
    by that id. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = _saved(plain.mapInArrow(_sign, "doc_id bigint, p0 bigint, p1 bigint, bands array<bigint>"), "signatures")
    with_words = signed.where("doc_id IS NOT NULL AND size(bands) > 0")
    alike = _saved(with_words.groupBy("p0", "p1", "bands").agg(F.min("doc_id").alias("rep")), "alike")
    members = _saved(_buckets(alike), "members")

    # Multisets of the candidates only, laid out by id so that rounds do not shuffle them.
    bags_name = f"bags_{uuid4().hex}"
    candidates = members.select("rep").distinct()
    # Always as a merge join: the texts move once, at every size, and a hot id is split.
    wanted = plain.join(candidates.hint("merge"), plain["doc_id"] == candidates["rep"], "left_semi")
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = wanted.mapInArrow(_bags, "doc_id bigint, bag binary")
    held.write.option("path", scratch_path(spark, "bags")).bucketBy(slots, "doc_id").sortBy("doc_id").saveAsTable(bags_name)
    try:
        bags = spark.table(bags_name)

        def linked(pairs: DataFrame) -> DataFrame:
            joined = pairs.dropDuplicates(["a", "b"]).join(bags.select(F.col("doc_id").alias("a"), F.col("bag").alias("bag_a")), "a").join(
                bags.select(F.col("doc_id").alias("b"), F.col("bag").alias("bag_b")), "b"
            )
            return _saved(joined.select(*LINK, "bag_a", "bag_b").mapInArrow(_verify, LINK_SCHEMA), "found")

        links = linked(_first_pairs(members).union(_full(members)))
        large = _saved(_moved(members.where(F.col("n") > SMALL).select("band", "key", "rep", F.col("rep").alias("class")), _hubs(links)), "large")
        parted, moves = _parted(large), []
        for k in range(ROUNDS):
            if parted.isEmpty():
                break
            found = linked(_led(parted, k))
            if found.isEmpty():
                break
            links = links.union(found)
            moves.append(_saved(_hubs(found), "moves"))
            parted = _parted(_moved(parted, moves[-1]))
        if not parted.isEmpty():
            left = large.join(parted.select("band", "key").distinct(), ["band", "key"], "left_semi").select("rep", "class").distinct()
            for move in moves:
                left = _moved(left, move)
            texts = bags.join(left, bags["doc_id"] == left["rep"]).select("rep", "class", "bag").dropDuplicates(["rep", "bag"])
            links = links.union(linked(_filtered(texts)))
        labels = components(links.select("a", "b"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {bags_name}")
    of_rep = alike.select("p0", "p1", "rep")
    of_rep = of_rep.join(labels, F.col("rep") == F.col("node"), "left").select("p0", "p1", F.coalesce("root", "rep").alias("rep"))
    # Ids that stand in several rows tie the classes of these rows together.
    joined = with_words.select("doc_id", "p0", "p1").join(of_rep, ["p0", "p1"]).groupBy("doc_id").agg(F.min("rep").alias("class_id"), F.max("rep").alias("other"))
    ties = joined.where("class_id <> other")
    if not ties.isEmpty():
        tied = components(ties.select(F.col("class_id").alias("a"), F.col("other").alias("b")))
        joined = joined.join(tied, F.col("class_id") == F.col("node"), "left").select("doc_id", F.coalesce("root", "class_id").alias("class_id"))
    return signed.select("doc_id").join(joined.select("doc_id", "class_id"), "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
